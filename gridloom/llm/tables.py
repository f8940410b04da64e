"""Reading inputs, cutting lineage and grouping linked rows, shared by the text operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FREE_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()
#: Arrow batches of texts: Spark's defaults would let each Python worker hold several times 64 MB.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864", "8388608")}


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once a session, as addPyFile does for any library.

    Arrow batches are made smaller where the session still has Spark's defaults for them.
    """
    for key, (default, smaller) in BATCHES.items():
        if spark.conf.get(key, default).rstrip("b") == default:
            spark.conf.set(key, smaller)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="gridloom-")) / "gridloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(top.rglob("*.py")):
            z.write(file, file.relative_to(top.parent))
    context.addPyFile(str(archive))


def row_identity(doc_id: Column, text: Column) -> list[Column]:
    """Two 64-bit hashes that tell a row's (doc_id, text) apart from all others; a missing id is an id of its own."""
    return [F.xxhash64(F.lit(k), doc_id.isNull(), doc_id, text) for k in (1, 2)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="gridloom-"))
        named = _OWN[0]
    return named.rstrip("/")


_MADE: list[tuple[SparkSession, str]] = []
_OWN: list[str] = []


@contextmanager
def scratch():
    """Tables that operators write inside go when it ends; the others when the interpreter does."""
    begin = len(_MADE)
    try:
        yield
    finally:
        while len(_MADE) > begin:
            _drop(*_MADE.pop())


def _drop_all() -> None:
    while _MADE:
        _drop(*_MADE.pop())


atexit.register(_drop_all)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clear
        pass


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Let Spark remove the shuffle files of what runs inside as soon as it has ended."""
    before = spark.conf.get(_FREE_SHUFFLE, None)
    spark.conf.set(_FREE_SHUFFLE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLE) if before is None else spark.conf.set(_FREE_SHUFFLE, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write a table in the shared folder and read it again.

    It cuts lineage so that a lost executor costs one stage at most, keeps an
    expensive step from running twice, and lets the step's shuffle files go.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gridloom-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.parquet(path)
    _MADE.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


#: Keys of the largest weights that ``skew_join`` broadcasts: no other key has more than a thousandth of the weight.
HEAVY = 1000


def skew_join(big: DataFrame, small: DataFrame, keys: list[str], weight: str, spread: list[str], how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` (a written table, one row a key) where a few keys may hold most rows of ``big``.

    The HEAVY rows of ``small`` with the largest ``weight`` are broadcast, and
    the rows of ``big`` that meet them are dealt by ``spread`` instead of by the
    key; all other rows meet in an ordinary join. The weight isn't returned.
    """
    values = [c for c in small.columns if c not in keys and c != weight]
    row = F.struct(*values)
    heavy = small.orderBy(F.desc(weight), *keys).limit(HEAVY).select(*keys, row.alias("_heavy"))
    big = big.join(F.broadcast(heavy), keys, "left")
    away = lambda i: F.xxhash64(F.lit(i), *spread)
    big = big.withColumns({f"_k{i}": F.when(F.col("_heavy").isNull(), F.col(k)).otherwise(away(i)) for i, k in enumerate(keys)})
    light = small.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), row.alias("_light"))
    joined = big.join(light.hint("merge"), [f"_k{i}" for i in range(len(keys))], "left").withColumn("_row", F.coalesce("_heavy", "_light"))
    if how == "inner":
        joined = joined.where("_row is not null")
    return joined.select(*(c for c in big.columns if c != "_heavy" and not c.startswith("_k")), *(F.col(f"_row.{v}").alias(v) for v in values))


def hash_sample(df: DataFrame, key: Column, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest hashes ``key`` (a long), or all, if there are fewer.

    Rows are filtered by the hash first, so that few reach the task that orders them: one
    pass counts the rows under each power of two, and the smallest that has enough is taken.
    """
    low = F.pmod(key, F.lit(1 << 30))
    under = df.agg(*(F.count_if(low < F.lit(1 << k)).alias(f"u{k}") for k in range(30))).first()
    enough = [k for k in range(30) if under[k] >= limit]
    if enough:
        df = df.where(low < F.lit(1 << enough[0]))
    return df.orderBy(low, key).limit(limit)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge table (a long, b long).

    Returns (id, component) for every id on an edge; component is the smallest
    id reachable. Each round lets every node point at the neighbour with the
    smallest hash and contracts the graph along these pointers, so nodes fall
    by a constant factor a round whatever the ids' order, and a star takes one
    round. Nothing but the number of edges left reaches the driver.
    """
    label = lambda c: F.xxhash64(c)  # noqa: E731  a bijection on longs
    edges = edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct()
    nodes = materialize(edges)
    left = nodes.select(label("a").alias("a"), label("b").alias("b"))
    rounds = []
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = materialize(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")))
        rounds.append(point)
        to_b = point.select(F.col("a").alias("b"), F.col("p").alias("q"))
        left = left.join(point, "a").join(to_b, "b").where("p <> q")
        left = materialize(left.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct())
        if left.isEmpty():
            break
    ids = nodes.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("p", label("id"))
    for point in rounds:
        step = point.select(F.col("a").alias("p"), F.col("p").alias("to"))
        ids = ids.join(step, "p", "left").select("id", F.coalesce("to", "p").alias("p"))
    ids = materialize(ids)
    least = ids.groupBy("p").agg(F.min("id").alias("component"))
    return ids.join(least, "p").select("id", "component")
