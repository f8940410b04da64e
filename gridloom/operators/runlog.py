"""The run log as tables: runs, and long tables of their metrics, parameters and tags."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import versions


def clean_metrics(metrics: DataFrame) -> DataFrame:
    """Null and NaN metrics aren't logged."""
    return metrics.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))


def log_runs(df: DataFrame, path: str, session: str = "session", again: bool = False) -> None:
    """Append, one folder a session. With ``again`` a session that is there already is written anew."""
    if again:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(session).parquet(path)
        return
    df.write.mode("append").partitionBy(*([session] if session in df.columns else [])).parquet(path)


def latest_run(runs: DataFrame) -> DataFrame:
    order = Window.partitionBy("device_id").orderBy(F.desc("start_time"), F.desc("run_id"))
    return runs.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def list_runs(runs: DataFrame, device_id: str | None = None) -> DataFrame:
    picked = runs if device_id is None else runs.where(F.col("device_id") == device_id)
    return picked.orderBy(F.desc("start_time"), "run_id")


def prune_runs(runs: DataFrame, days: int, now: str, dry_run: bool = False) -> DataFrame:
    """The runs that stay, or with dry_run those that would go: started more than ``days`` days before ``now``."""
    old = F.col("start_time") < F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return runs.where(old if dry_run else F.coalesce(~old, F.lit(True)))


def prune_log(spark: SparkSession, path: str, days: int, now: str, dry_run: bool = False, session: str = "session", store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Delete the runs of a written log that started more than ``days`` days before ``now``; returns them.

    Sessions that lose all their runs lose their folder; those that lose some are written
    anew, from a copy that ``store`` makes; the files of all others stay untouched. With
    dry_run nothing is written.
    """
    log = spark.read.parquet(path)
    if session not in log.columns:
        raise ValueError(f"the log isn't partitioned by {session}")
    old = prune_runs(log, days, now, dry_run=True)
    if dry_run:
        return old
    if store is None:
        raise ValueError("a copy has to be stored while folders are written anew")
    gone = store(old)
    left = prune_runs(log, days, now).groupBy(session).agg(F.count("*").alias("_left"))
    hit = gone.select(session).distinct().join(left, session, "left").select(F.col(session).cast("string").alias("s"), F.coalesce("_left", F.lit(0)).alias("n")).collect()  # a row a session that changes
    part = [r.s for r in hit if r.n]
    if part:
        kept = store(prune_runs(log.where(F.col(session).cast("string").isin(part)), days, now))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(session).parquet(path)
    for r in hit:
        if not r.n:
            versions.delete(spark, f"{path}/{session}={r.s}")
    return gone


def lineage_tags(spark: SparkSession, tables: Sequence[str], registry: DataFrame) -> DataFrame:
    """table, license, classification, owner, source_system of the tables that a run read; defaults where the registry is silent.

    A table that the registry doesn't hold has no tags.
    """
    read = spark.createDataFrame([(t,) for t in tables], "table string")
    joined = read.join(registry.select("table", "license", "classification", "owner", "source_system"), "table")
    return joined.na.fill({"license": "unknown", "classification": "green", "owner": "unknown", "source_system": "unknown"})


def run_tags(reads: DataFrame, registry: DataFrame, project: Mapping[str, str] | None = None, owners: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """run_id, key, value: what is known of the project of each run, and of the tables that it read.

    reads: run_id and table (null for a run that read none); registry: one row a table with license, classification,
    source_system and ownership, an array of (type, name). Every run gets the project's license,
    source_system, classification and source_url, as far as they are given, and
    owner.<type> for each of its owners (of two of a type the last). A table of the registry gives input.<table>.<key>,
    with defaults where the registry is silent and the first owner's name if there is one; other tables give nothing.
    """
    own = {k: v for k in ("license", "source_system", "classification", "source_url") if (v := (project or {}).get(k))}
    own |= {f"owner.{kind}": name for kind, name in owners}
    pair = lambda key, value: F.struct(key.alias("key"), value.alias("value"))
    of = lambda name: F.concat(F.lit("input."), F.col("table"), F.lit(f".{name}"))
    owner = F.when(F.size("ownership") > 0, F.coalesce(F.get("ownership", F.lit(0))["name"], F.lit("unknown")))
    told = [pair(of(name), F.coalesce(name, F.lit(default))) for name, default in (("license", "unknown"), ("classification", "green"), ("source_system", "unknown"))]
    known = reads.select("run_id", "table").distinct().join(registry.select("table", "license", "classification", "source_system", "ownership"), "table")
    tags = known.select("run_id", F.inline(F.array(*told, pair(of("owner"), owner)))).where("value is not null")
    if not own:
        return tags
    project_tags = F.inline(F.array(*(pair(F.lit(k), F.lit(v)) for k, v in own.items())))
    return tags.unionByName(reads.select("run_id").distinct().select("run_id", project_tags))
