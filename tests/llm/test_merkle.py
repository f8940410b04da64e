"""The Merkle manifest against a tree built by hand."""

from __future__ import annotations

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom.llm import merkle_manifest as M
from gridloom.llm import queries
from gridloom.llm.tables import read

from .fixtures import DOCS, EXTRA, documents, lower, sha


def leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(fields).encode())


def climb(nodes):
    """(top, siblings (left, right) of each node level by level)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
            paths[i].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        nodes = [sha("".join(nodes[k : k + 8]).encode()) for k in range(0, len(nodes), 8)]
        where = [at // 8 for at in where]
    return nodes[0], paths


def fold(node, path):
    for left, right in path:
        node = sha((left + node + right).encode())
    return node


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: climb([leaf(r) for r in own[x]]) for x in langs}
    root, above = climb([trees[x][0] for x in langs])
    out = []
    for at, x in enumerate(langs):
        for r, path in zip(own[x], trees[x][1], strict=True):
            path = path + above[at]
            touched = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            end = fold(leaf((r[0], lower(r[1]), *r[2:])) if touched else leaf(r), path)
            out.append((r[0], leaf(r), trees[x][0], root, "".join(a + b for a, b in path), end, end == root))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]


def compare(spark, rows):
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in EXTRA}).repartition(3)
    assert ordered(map(tuple, M.audit(df).select(COLUMNS).collect())) == ordered(brute(rows))


def test_awkward_rows(spark):
    """Nulls in all columns, empty and long texts, repeated rows, shared ids, a lone row in its language."""
    rows = documents() + [(7, "Other", "en", None, None), (None, None, None, None, None), (None, None, None, None, None), (300, "A", "", "s", 1), (301, "Z", "é", "s", 1), (302, "Z", "z", "s", 1)]
    compare(spark, rows)


@pytest.mark.parametrize("counts", [(1,), (8, 9), (64, 65, 1), (512, 513), (1, 1, 1, 1, 1, 1, 1, 1, 1)])
def test_sizes_at_the_edges_of_runs_and_blocks(spark, counts):
    compare(spark, [(i * 10 + k, f"Text {i}", f"l{k}", "s", i) for k, n in enumerate(counts) for i in range(n)])


def test_many_rounds_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 8)
    compare(spark, [(i, f"Text {i}", f"l{i % 11 and 1}{i % 90 and 2}", "s", i) for i in range(700)])


def test_manifest_and_no_rows(spark):
    rows = documents(n=20)
    df = spark.createDataFrame(rows, DOCS)
    got = M.manifest(df).select("doc_id", "leaf", "subroot", "root", "proof").collect()
    assert ordered(map(tuple, got)) == ordered(r[:5] for r in brute(rows))
    assert M.audit(df.limit(0)).collect() == [] and M.manifest(df.limit(0)).collect() == []


def test_a_language_of_most_rows_is_spread(spark):
    df = spark.createDataFrame([(i, "x", "en", "s", 1) for i in range(4000)], DOCS)
    rows = M.numbered(M.leaves(df), "lang", ["doc_id", "leaf"])
    assert {r._pos for r in rows.collect()} == set(range(4000)) and rows.select("_n").distinct().collect()[0][0] == 4000
    most = df.repartitionByRange(4, "lang", "doc_id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 2500


def test_query_equals_its_sql_and_brute_force(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = duck.sql(queries.ORACLE_SQL["op12_merkle_manifest"]).fetchall()
    got = queries.op12_merkle_manifest(spark, sf_dir)
    found = ordered(map(tuple, got.collect()))
    assert found == ordered(want)
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert found == ordered((*r[:4], sha(r[4].encode()), *r[5:]) for r in brute(rows))
    assert {r[-1] for r in found} == {True, False}


def test_no_python_runs(spark):
    df = spark.createDataFrame(documents(n=5), DOCS)
    assert "Python" not in M.audit(df)._jdf.queryExecution().executedPlan().toString()
