"""Results are rounded as their SQL rounds them, halves included."""

from __future__ import annotations

import random

import duckdb

from gridloom.plans.base import out, rounded


def test_halves_are_rounded_as_in_sql(spark):
    rnd = random.Random(3)
    # 348.76 * 1.25 + 91.0521875, a bound that i3_apply_cqr gives; then halves of the seventh decimal of either sign
    values = [526.8021875, 0.0, -0.0, 2.5e-7, -7.5e-7, 1e300, -1.7e308, float("inf"), float("nan"), None]
    values += [rnd.choice((-1, 1)) * (rnd.randrange(10**9) + 0.5) / 1e6 for _ in range(5000)]
    values += [(rnd.randrange(10**8) + 0.5) / 1e5 for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    for digits, df in ((6, out(df)), (5, out(df.withColumn("x", rounded("x", 5))))):
        got = [r.x for r in df.orderBy("i").collect()]
        want = [x for (x,) in con.sql(f"SELECT round(x, {digits}) + 0.0 FROM t ORDER BY i").fetchall()]
        assert list(map(repr, got)) == list(map(repr, want))
        assert got[0] == (526.802187 if digits == 6 else 526.80219)
