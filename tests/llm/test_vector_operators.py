from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import ivf_pq as A
from gridloom.llm import multi_index as M
from gridloom.llm.tables import read

KIND = "vec_id long, embedding array<float>, label int"


def table(spark, n=400, dim=12, seed=0):
    """Clusters of near and exact copies at both sides of the threshold, and every unusable vector."""
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n // 8, dim))
    rows = []
    for i in range(n):
        v = base[rnd.integers(len(base))]
        v = v + rnd.normal(size=dim) * np.linalg.norm(v) / np.sqrt(dim) * rnd.choice([0, 0.1, 0.25, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v * rnd.choice([1.0, 3.0])], int(rnd.integers(3))))
    rows += [(n, None, 1), (n + 1, [0.0] * dim, 1), (n + 2, [1.0, None] + [0.0] * (dim - 2), 1), (n + 3, [float("nan")] * dim, 1), (n + 4, [float("inf")] + [0.0] * (dim - 1), 1)]
    rows += [(n + 5, rows[0][1], None), (n + 6, [], 1), (n + 7, [1.0], 1), (n + 8, [2.0], 1), (50, rows[50][1], rows[50][2])]
    return rows, spark.createDataFrame(rows, KIND).withColumns({"h1": F.lit(1), "v": F.lit("v"), "cell": F.lit(0)}).repartition(4)


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return a @ b / np.linalg.norm(a) / np.linalg.norm(b)


def brute_links(rows, least):
    n = len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if x is not None and x == y and good(a) and good(b) and len(a) == len(b) and cosine(a, b) >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low: dict = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], links[i], low[find(i)], rows[i][0] == low[find(i)]) for i in range(n))


@pytest.mark.parametrize(("cell", "block"), [(256, 1024), (10, 16)])
def test_near_duplicates(spark, monkeypatch, cell, block):
    monkeypatch.setattr(M, "CELL", cell)
    monkeypatch.setattr(M, "BLOCK", block)
    rows, df = table(spark)
    got = sorted(tuple(r) for r in M.near_duplicates(df, 0.93, recall=1.0).select("vec_id", "n_links", "component_id", "kept").collect())
    want = brute_links(rows, 0.93)
    assert len(got) == len(want)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True)) and found >= 0.97 * there > 0
    if cell == 256:
        assert got == want


def test_multi_sequence_is_sorted_and_complete():
    rnd = np.random.default_rng(0)
    a, b = rnd.random(7), rnd.random(5)
    order = M.multi_sequence(a, b, 35)
    sums = [a[i] + b[j] for i, j in order]
    assert len(set(order)) == 35 and sums == sorted(sums) and M.multi_sequence(a, b, 3) == order[:3]


def test_no_usable_vectors(spark):
    rows = [(1, None, 1), (2, [0.0], 1), (3, [1.0], None)]
    df = spark.createDataFrame(rows, KIND)
    assert sorted(tuple(r) for r in M.near_duplicates(df).collect()) == [(i, 0, i, True) for i in (1, 2, 3)]
    assert M.near_duplicates(df.limit(0)).count() == 0 and A.nearest(df.limit(0), F.lit(True)).count() == 0
    assert A.nearest(df, F.col("vec_id") == 3).count() == 0


def test_nearest(spark, monkeypatch):
    build = A.build
    rows, df = table(spark)
    part = [(i, v) for i, v, _ in rows if good(v) and len(v) == 12]
    monkeypatch.setattr(A, "build", lambda *a: build(*a)._replace(probes=len(build(*a).centers)))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in A.nearest(df, F.col("vec_id") % 50 == 0, k=5).collect())
    want = []
    for q in sorted({i for i, _ in part if i % 50 == 0}):
        v = min(w for i, w in part if i == q)
        near = sorted((-round(cosine(v, w), 12), i) for i, w in part if i != q)[:5]
        want += [(q, k, i) for k, (_, i) in enumerate(near, 1)]
    # copies that are scaled may differ in the last bit, so ranks are compared by score
    vector = {i: min(w for j, w in part if j == i) for i, _ in part}
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[3] for r in got] == pytest.approx([cosine(vector[q], vector[i]) for q, _, i in want], abs=1e-12)
    assert all(q != i for q, _, i, _ in got)
    assert all(s == pytest.approx(cosine(vector[q], vector[i]), abs=1e-12) for q, _, i, s in got if len([1 for j, _ in part if j == i]) == 1)


def test_a_repeated_query_row_asks_once(spark):
    rows = [(0, [1.0, 0.0], 1)] * 2 + [(0, [1.0, 0.1], 1)] + [(i, [1.0, i / 10], 1) for i in range(1, 8)]
    got = A.nearest(spark.createDataFrame(rows, KIND), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(i, i) for i in range(1, 6)]


def linked_table(n, dim, seed):
    """Clusters of uneven spread along uneven axes: half of the vectors have partners near the threshold."""
    rnd = np.random.default_rng(seed)
    axes = np.geomspace(1, 0.05, dim)
    base = rnd.standard_normal((n // 2, dim)) * axes
    near = base[rnd.integers(0, len(base), n - len(base))]
    near = near + rnd.standard_normal(near.shape) * axes * rnd.uniform(0.05, 0.6, (len(near), 1))
    return np.concatenate([base, near])


def test_recall_of_links_through_a_real_grid(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 8)
    x = linked_table(4000, 32, 1)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], KIND)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = unit @ unit.T >= 0.93
    np.fill_diagonal(hit, False)
    want = hit.sum(axis=1)
    got = {r.vec_id: r.n_links for r in M.near_duplicates(df).collect()}
    assert all(got[i] <= want[i] for i in got) and sum(got.values()) >= 0.95 * want.sum() > 1000


def test_the_grid_decides_what_is_compared(spark, monkeypatch):
    """With one cell visited only links inside cells are found, so fewer than with the measured depth."""
    monkeypatch.setattr(M, "CELL", 8)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(linked_table(1500, 16, 2))], KIND)
    build = M.build
    whole = M.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    monkeypatch.setattr(M, "build", lambda *a: build(*a)._replace(depth=1))
    assert M.near_duplicates(df).agg(F.sum("n_links")).first()[0] < whole


def test_visits_before_a_cell_are_counted():
    rnd = np.random.default_rng(0)
    left, right, x, y = rnd.random((5, 3)), rnd.random((6, 3)), rnd.random((40, 6)), rnd.random((40, 6))
    got = M.visited_before(x, y, left, right)
    for k in range(40):
        a, b = M.V.distances(x[k : k + 1, :3], left)[0], M.V.distances(x[k : k + 1, 3:], right)[0]
        i, j = M.V.distances(y[k : k + 1, :3], left).argmin(), M.V.distances(y[k : k + 1, 3:], right).argmin()
        assert M.multi_sequence(a, b, 30).index((i, j)) + 1 == got[k]


def test_a_query_alone_in_its_list_goes_on_to_others(spark, monkeypatch):
    """One list visited, and the query's list holds only its own two rows: five come back nevertheless."""
    rnd = np.random.default_rng(3)
    rows = [(i, [1.0, *rnd.normal(scale=0.01, size=3).tolist()], 1) for i in range(1, 60)] + [(0, [0.0, 0.0, 0.0, 1.0], 1)] * 2
    build = A.build
    monkeypatch.setattr(A, "build", lambda *a: build(*a)._replace(centers=np.array([[1.0, 0, 0, 0], [0, 0, 0, 1.0]]), probes=1))
    got = A.nearest(spark.createDataFrame(rows, KIND).limit(60), F.col("vec_id") == 0).collect()
    twice = A.nearest(spark.createDataFrame(rows, KIND), (F.col("vec_id") == 0) & (F.col("label") == 1)).collect()
    want = sorted(range(1, 60), key=lambda i: (-cosine(rows[i - 1][1], [0, 0, 0, 1.0]), i))[:5]
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == want
    assert len(twice) == 5 and {r.vec_id for r in twice} <= set(range(1, 60))


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1)], KIND)
    assert [(r.rank, r.vec_id) for r in A.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_recall_on_the_table(spark, sf_dir):
    df = read(spark, sf_dir.replace("sf0.001", "sf0.1"), "embeddings")
    pdf = df.toPandas()
    x = np.stack(pdf.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    at = {v: i for i, v in enumerate(pdf.vec_id)}
    found: dict = {}
    for r in A.nearest(df, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits, asked = 0, [q for q in pdf.vec_id if q % 50 == 0]
    for q in asked:
        s = x @ x[at[q]]
        s[at[q]] = -9
        hits += len(found.get(q, set()) & set(pdf.vec_id[np.argsort(-s)[:5]]))
    assert hits >= 0.9 * 5 * len(asked)


def test_very_large_and_small_components(spark):
    """Finite, so they take part, though their squares are neither."""
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((60, 6))
    rows = [(i, (v * scale).tolist(), 1) for i, (v, scale) in enumerate(zip(x, np.tile([1e200, 1.0, 1e-200], 20), strict=True))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for r in A.nearest(df, F.col("vec_id") % 10 == 0).collect():
        assert r.score == pytest.approx(cosine(x[r.query_id], x[r.vec_id]), abs=1e-12)
    got = {(r.query_id, r["rank"]): r.vec_id for r in A.nearest(df, F.col("vec_id") == 0).collect()}
    assert [got[0, k] for k in range(1, 6)] == sorted(range(1, 60), key=lambda i: -cosine(x[0], x[i]))[:5]


def test_a_third_of_the_rows_under_one_id(spark, monkeypatch):
    """The sample isn't empty, whatever the id's hash, and no row is lost."""
    monkeypatch.setattr(A, "SAMPLE", 40)
    rows = [(7, [1.0, i / 900], 1) for i in range(400)] + [(0, [1.0, 0.5], 1)]
    assert [r.vec_id for r in A.nearest(spark.createDataFrame(rows, KIND), F.col("vec_id") == 0).collect()] == [7] * 5
    same = spark.createDataFrame([(7, [1.0, 0.0], 1)] * 500 + [(None, [1.0, 0.0], 1)] * 300 + [(i, [0.0, 1.0], None) for i in range(8, 300)], KIND)
    monkeypatch.setattr(M, "SAMPLE", 40)
    got = M.near_duplicates(same).groupBy("vec_id", "n_links", "component_id", "kept").count().collect()
    assert {tuple(r) for r in got} == {(7, 499, 7, True, 500), (None, 0, None, False, 300)} | {(i, 0, i, True, 1) for i in range(8, 300)}


def test_vectors_that_share_an_id_have_their_own_links(spark):
    rows = [(1, [1.0, 0.0, 0.0], 1), (1, [0.0, 1.0, 0.0], 1), (2, [1.0, 0.01, 0.0], 1), (3, [0.0, 0.0, 1.0], 1)]
    got = sorted(tuple(r) for r in M.near_duplicates(spark.createDataFrame(rows, KIND)).collect())
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_near_duplicates_equal_the_sql_where_there_are_links(spark, sf_dir):
    """The tables have no link at 0.93, so the query's SQL is compared at 0.4."""
    import duckdb

    from gridloom.llm import queries

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = duck.sql(queries.ORACLE_SQL["op10_embedding_near_dedup"].replace("0.93", "0.4")).fetchall()
    got = [tuple(r) for r in M.near_duplicates(read(spark, sf_dir, "embeddings"), 0.4, recall=1.0).collect()]
    assert sum(r[1] for r in want) >= 10 and sorted(got) == sorted(want)
