"""Stream state that is merged, last readings by the watermark, a log that is pruned, and a database that is read in parts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridloom.config import Config
from gridloom.operators import cleaning as C
from gridloom.operators import models as M
from gridloom.operators import runlog as L
from gridloom.sources import readers as S
from gridloom.sources import versions as W
from gridloom.streaming import streams as T

START = dt.datetime(2025, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    def write(df):
        path = str(tmp_path / f"stored{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_many_batches_leave_one_version(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"d{i % 3}", float(rnd.random()), float(rnd.random())) for i in range(400)]
    df = spark.createDataFrame(rows, "device_id string, y double, x double")
    df.repartition(20).write.parquet(str(tmp_path / "rows"))
    linear = M.GroupedLinear("y", ["x"], ["device_id"])
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "rows"))
    T.stream_model_update(stream(), linear, str(tmp_path / "state"), str(tmp_path / "mark")).awaitTermination()
    assert W.versions(spark, str(tmp_path / "state")) == [19] and W.folders(spark, str(tmp_path / "state")) == ["version=19"]
    want = {r.device_id: r for r in linear.statistics(df).collect()}
    held = T.current_statistics(spark, str(tmp_path / "state")).collect()
    for r in held:
        assert r.n == want[r.device_id].n and r.xx == pytest.approx(want[r.device_id].xx) and r.xy == pytest.approx(want[r.device_id].xy)
    # a lost checkpoint replays all batches under their old numbers, and a new batch goes on
    T.stream_model_update(stream(), linear, str(tmp_path / "state"), str(tmp_path / "mark2")).awaitTermination()
    assert sorted(T.current_statistics(spark, str(tmp_path / "state")).collect()) == sorted(held)
    df.limit(30).write.mode("append").parquet(str(tmp_path / "rows"))
    T.stream_model_update(stream(), linear, str(tmp_path / "state"), str(tmp_path / "mark")).awaitTermination()
    assert T.current_statistics(spark, str(tmp_path / "state")).agg(F.sum("n")).first()[0] == 430


def test_a_version_that_was_not_finished_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    assert W.current(spark, path) is None
    assert W.replace(spark, path, 0, lambda old: spark.range(3))
    spark.range(99).write.parquet(f"{path}/version=1")
    (tmp_path / "t/version=1/_SUCCESS").unlink()
    assert W.versions(spark, path) == [0] and W.current(spark, path).count() == 3
    assert W.replace(spark, path, 1, lambda old: old.union(old)) and W.current(spark, path).count() == 6
    assert not W.replace(spark, path, 1, lambda old: spark.range(0)) and not W.replace(spark, path, 0, lambda old: spark.range(0))
    assert W.current(spark, path).count() == 6 and W.folders(spark, path) == ["version=1"]


def test_last_readings_equal_the_batch_form(spark, tmp_path):
    """Out of order, corrected twice, with nulls and ties: the hours that the watermark has passed are those of the batch."""
    rnd = random.Random(2)
    rows = []
    for k in range(3):
        for i in range(4 * 30):
            ts = START + dt.timedelta(minutes=15 * i)
            for version in range(rnd.choice((1, 1, 2, 3))):
                rows.append((f"d{k}", ts, None if rnd.random() < 0.05 else round(rnd.random(), 3), round(rnd.random(), 3), version if rnd.random() < 0.9 else 0))
    kind = "device_id string, ts timestamp, consumption_kwh double, production_kwh double, arrived long"
    rows.sort(key=lambda r: r[1] + dt.timedelta(minutes=rnd.randint(0, 100)))
    at = len(rows) // 3
    for n, part in enumerate((rows[:at], rows[at : 2 * at], rows[2 * at :], [("d0", START + dt.timedelta(days=3), 1.0, 1.0, 0)])):
        rnd.shuffle(part)
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = T.stream_last_readings(stream, "arrived", "2 hours")
        out.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out")).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = C.dedupe_readings(spark.createDataFrame(rows, kind), "arrived")
    columns = ["device_id", "ts", "consumption_kwh", "production_kwh", "arrived"]
    assert sorted(map(str, streamed.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))
    hourly = lambda df: sorted(map(str, C.hourly_rollup(df, Config()).withColumns({c: F.round(c, 9) for c in ("M1_cons", "M1_prod")}).collect()))
    assert hourly(streamed) == hourly(batch)


def test_pruning_deletes_from_the_log(spark, tmp_path, store):
    path = str(tmp_path / "log")
    runs = [(f"r{i}", "dev", START + dt.timedelta(days=i), ("old", "mixed", "new")[0 if i < 3 else 1 if i < 8 else 2]) for i in range(12)] + [("none", "dev", None, "mixed")]
    L.log_runs(spark.createDataFrame(runs, "run_id string, device_id string, start_time timestamp, session string"), path)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet")}
    before, now = files(), str(START + dt.timedelta(days=12))
    assert {r.run_id for r in L.prune_log(spark, path, 7, now, dry_run=True).collect()} == {f"r{i}" for i in range(5)} and files() == before
    assert {r.run_id for r in L.prune_log(spark, path, 7, now, store=store).collect()} == {f"r{i}" for i in range(5)}
    assert {r.run_id for r in spark.read.parquet(path).collect()} == {*(f"r{i}" for i in range(5, 12)), "none"}
    after = files()
    same = {p for p in before if "session=new" in str(p)}
    assert same and all(after.get(p) == before[p] for p in same)
    assert not (tmp_path / "log/session=old").exists() and not any("session=mixed" in str(p) and p in before for p in after)
    assert L.prune_log(spark, path, 7, now, store=store).count() == 0 and files() == after


def test_database_is_read_in_parts_with_filters_pushed(spark):
    jdbc = {"url": "jdbc:derby:memory:gridloom;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(100).select(F.col("id").cast("int").alias("ID"), F.concat(F.lit("d"), (F.col("id") % 5).cast("string")).alias("DEVICE_ID"), (F.col("id") / 10).alias("V"))
    df.write.format("jdbc").options(**jdbc, dbtable="READINGS", createTableColumnTypes="DEVICE_ID VARCHAR(20)").mode("overwrite").save()
    parts = S.read_table(spark, "READINGS", {"DEVICE_ID": ["d1", "d3"]}, jdbc=jdbc, split="ID", connections=4)
    assert parts.rdd.getNumPartitions() == 4
    assert sorted(r.ID for r in parts.collect()) == [i for i in range(100) if i % 5 in (1, 3)]
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*In(DEVICE_ID" in plan and "numPartitions=4" in plan
    sizes = [len(x) for x in S.read_table(spark, "READINGS", jdbc=jdbc, split="ID", connections=4).rdd.glom().collect()]
    assert sum(sizes) == 100 and max(sizes) <= 30
    assert S.read_table(spark, "READINGS", jdbc=jdbc).rdd.getNumPartitions() == 1
    named = S.read_table(spark, "READINGS", device_ids=["d2"], jdbc=jdbc, column_map={"DEVICE_ID": "device_id"}, split="ID")
    assert named.count() == 20 and "*EqualTo(DEVICE_ID,d2)" in named._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        S.read_table(spark, "READINGS", jdbc=jdbc, split="ID; DROP TABLE READINGS")
    df.limit(0).write.format("jdbc").options(**jdbc, dbtable="NOTHING", createTableColumnTypes="DEVICE_ID VARCHAR(20)").mode("overwrite").save()
    assert S.read_table(spark, "NOTHING", jdbc=jdbc, split="ID").count() == 0
