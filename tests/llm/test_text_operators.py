from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

from gridloom.llm import compression_quality as Q
from gridloom.llm import hashing as H
from gridloom.llm import line_dedup as L
from gridloom.llm import mixing as X
from gridloom.llm import phrase_automata as P
from gridloom.llm import queries
from gridloom.llm import secret_scan as S
from gridloom.llm import sentence_pieces as SP
from gridloom.llm import shingle_join as J
from gridloom.llm import suffix_repeats as R
from gridloom.llm.linking import forest
from gridloom.llm.tables import components, read

from .fixtures import DOCS, EXTRA, brute_bytes, brute_jaccard, brute_lines, brute_words, documents


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def wide(docs):
    return docs.withColumns({c: F.lit(c) for c in EXTRA})


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)] + [(1, None), (7, 5)], "doc_id long, quality int")


def same(df, want, columns):
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(map(key, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(key, want))


@pytest.mark.parametrize("size", [40, 400])
def test_suffix_dedup(docs, rows, size):
    same(R.suffix_dedup(docs, size), brute_bytes(rows, size), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


@pytest.mark.parametrize("size", [5, 35])
def test_phrase_dedup(docs, rows, size):
    same(P.phrase_dedup(docs, size), brute_words(rows, size), ["doc_id", "n_words", "n_removed", "kept_sha256"])


def test_hot_anchors_give_the_same(docs, rows, monkeypatch):
    monkeypatch.setattr(R.R, "HOT", 1)
    same(R.suffix_dedup(docs, 60), brute_bytes(rows, 60), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    same(P.phrase_dedup(docs, 12), brute_words(rows, 12), ["doc_id", "n_words", "n_removed", "kept_sha256"])


def test_an_anchor_in_very_many_segments_is_dealt_again(spark, monkeypatch):
    """More distinct segments than HOT share one gram; only some windows repeat."""
    monkeypatch.setattr(R.R, "HOT", 500)
    rnd = random.Random(8)
    gram, words = " ".join(f"g{i}" for i in range(12)), lambda k: " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(90)) for _ in range(k))
    tail = words(25)
    rows = [(i, f"{words(30)} {gram} {tail if i % 9 == 0 else words(25)}", "en", "s", 1) for i in range(R.R.HOT + 200)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    units = P.word_units(35)
    found = R.R.occurrences(R.R.keyed(df).withColumn("copies", F.lit(1).cast("long")), units, units.grams[0])
    assert R.R.recurring(found).where("hot").count() > R.R.HOT
    same(P.phrase_dedup(df, 35), brute_words(rows, 35), ["doc_id", "n_words", "n_removed", "kept_sha256"])
    same(R.suffix_dedup(df, 160), brute_bytes(rows, 160), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def test_grams_grow_to_the_window():
    assert R.R.gram_lengths(400, 64) == (64, 128, 256, 400) and R.R.gram_lengths(35, 12) == (12, 24, 35) and R.R.gram_lengths(3, 9) == (3,)


def test_rows_without_an_id_whose_texts_hash_alike(spark):
    """Pairs of null-id texts, one short and one long, that Spark's 32-bit hash takes for equal."""
    rnd = random.Random(3)
    words = lambda k: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(k))
    shared, head = words(50), words(60)
    ids = spark.range(150_000).select(F.concat(F.lit("s"), "id").alias("a"), F.concat(F.lit(head + " " + shared + " e"), "id").alias("b"))
    short, long = ids.select("a", F.hash("a").alias("h")), ids.select("b", F.hash("b").alias("h"))
    pairs = short.join(long, "h").limit(3).collect()
    assert pairs
    rows = [(None, p[c], "en", "s", 1) for p in pairs for c in ("a", "b")] + [(7, shared, "en", "s", 1), (-(1 << 63), shared + " z", "en", "s", 1), (None, shared + " z", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    same(P.phrase_dedup(df, 35), brute_words(rows, 35), ["doc_id", "n_words", "n_removed", "kept_sha256"])
    same(R.suffix_dedup(df, 100), brute_bytes(rows, 100), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    library = sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    got = SP.encode(df.select("doc_id", "text"), giant=4).collect()
    assert len(got) == len(rows) and all(list(r.ids) == library.encode(r.text) for r in got)


def thue_morse(n, first="a", second="b"):
    return "".join(second if i.bit_count() % 2 else first for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_thue_morse_words_are_told_apart(spark, n):
    """A word of this kind and its complement collide under polynomials modulo powers of two, whatever the base."""
    one, two = thue_morse(n), thue_morse(n, "b", "a")
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"x y {one} z w", "en", "s", 1), (2, f"x y {two} z w", "en", "s", 1), (3, f"{one} {rest}", "en", "s", 1), (4, f"{two} {rest}", "en", "s", 1)]
    rows += [(5, " ".join(c + "x" for c in one), "en", "s", 1), (6, " ".join(c + "x" for c in two), "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    same(J.jaccard_components(df, 3, 90, 100), brute_jaccard(rows, 3, 90, 100), ["doc_id", "n_shingles", "component_id"])
    same(P.phrase_dedup(df, 35), brute_words(rows, 35), ["doc_id", "n_words", "n_removed", "kept_sha256"])
    same(R.suffix_dedup(df, 400), brute_bytes(rows, 400), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def test_arithmetic_modulo_the_prime():
    rnd, p = random.Random(1), int(H.PRIME)
    a, b = ([rnd.randrange(p) for _ in range(500)] + [0, 1, p - 1, p] for _ in range(2))
    assert H.multiply(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)).tolist() == [x * y % p for x, y in zip(a, b, strict=True)]
    total, v = 0, [rnd.randrange(1 << 64) for _ in range(300)]
    sums = H.running(np.array(v, dtype=np.uint64)).tolist()
    for i, x in enumerate(v):
        total = (total + (x & p) * pow(H.BASE, i, p)) % p
        assert sums[i + 1] == total


def test_the_automaton_decides(monkeypatch):
    """Spans are its matches: without it there are none, and counting alone would keep a window that occurs once."""
    texts = [tuple(range(10)), (99, *range(2, 8)), tuple(range(50, 60))]
    assert P.matches(texts, [1, 1, 1], 4) == [[(2, 8)], [(1, 7)], []] and P.matches(texts[2:], [2], 4) == [[(0, 10)]]
    with monkeypatch.context() as m:
        m.setattr(P.H, "range_hashes", lambda total, first, last: np.zeros(len(first), np.uint64))  # all windows look alike
        assert P.matches([tuple(range(4)), tuple(range(4, 8))], [1, 1], 4) == [[], []]
    build = P.automaton
    monkeypatch.setattr(P, "automaton", lambda p: (type("Blind", (), {"iter": lambda self, t: iter(())})(), build(p)[1]))
    assert P.matches(texts, [1, 1, 1], 4) == [[], [], []]


def test_repeat_groups_hold_all_occurrences(spark):
    rnd = random.Random(5)
    base = "".join(rnd.choice("abcdef") for _ in range(90))
    rows = [(1, "x" + base + "y", "en", "s", 1), (2, base, "en", "s", 1), (3, "zz" + base + "q", "en", "s", 1), (4, "nothing here", "en", "s", 1), (None, base[:60], "en", "s", 1)]
    got = R.repeat_groups(spark.createDataFrame(rows, DOCS), 50).collect()
    text = {r[0]: r[1] for r in rows}
    groups: dict = {}
    for r in got:
        groups.setdefault((r.group, r.length), set()).add((r.doc_id, r.start, text[r.doc_id][r.start : r.start + r.length]))
    assert groups and all(len({t for _, _, t in g}) == 1 for g in groups.values())
    for (_, length), g in groups.items():
        inside = next(iter(g))[2]
        assert {(i, k) for i, t in text.items() for k in range(len(t) - length + 1) if t[k : k + length] == inside} == {(i, k) for i, k, _ in g}
    assert {k for k, g in groups.items() if len(g) == 3} and {k for k, g in groups.items() if len(g) == 4}


def test_kept_text(docs):
    assert P.phrase_dedup(docs, keep_text=True).where("kept is null").count() == 0
    assert R.suffix_dedup(docs, keep_text=True).where("kept is null").count() == 0


def test_maximal_repeats_are_all_found():
    rnd = random.Random(2)
    for _ in range(30):
        text = bytes(rnd.choice(b"ab") for _ in range(60))
        total = R.H.running(R.H.BYTE_HASH[np.frombuffer(text, dtype=np.uint8)])
        n, least = len(text), 4
        starts = np.arange(n - least + 1)
        got = {(length, tuple(sorted(where.tolist()))) for length, where in R.maximal_repeats(text, total, starts, np.zeros_like(starts), np.full_like(starts, n), least)}
        want = set()
        for length in range(least, n):
            for s in {text[i : i + length] for i in range(n - length + 1)}:
                at = [i for i in range(n - length + 1) if text[i : i + length] == s]
                left = {text[i - 1] if i else -1 for i in at}
                right = {text[i + length] if i + length < n else -1 for i in at}
                if len(at) > 1 and len(left) > 1 and len(right) > 1:
                    want.add((length, tuple(at)))
        assert got == want


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (2, 50)])
def test_jaccard(docs, rows, k, num):
    same(J.jaccard_components(docs, k, num, 100), brute_jaccard(rows, k, num, 100), ["doc_id", "n_shingles", "component_id"])


def test_jaccard_of_a_large_family_in_many_blocks(spark, monkeypatch):
    """Hundreds of near copies, many of which don't link directly; blocks are small so that they meet in pairs."""
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 2000)
    monkeypatch.setattr(J, "GROUP", 16)
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(60)] = f"x{rnd.randrange(50)}"
        rows.append((i, " ".join(w[: rnd.choice((60, 58, 55))]), "en", "s", 1))
    df = spark.createDataFrame(rows, DOCS)
    for num in (90, 80):
        same(J.jaccard_components(df, 3, num, 100), brute_jaccard(rows, 3, num, 100), ["doc_id", "n_shingles", "component_id"])


def test_similar_sets_share_a_signature():
    rnd = np.random.default_rng(0)
    for _ in range(400):
        n = int(rnd.integers(1, 200))
        a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        drop = rnd.random(len(a)) < rnd.random() * 0.15
        b = np.unique(np.concatenate([a[~drop], rnd.integers(0, 1 << 63, int(rnd.integers(0, 1 + n // 10))).astype(np.uint64)]))
        both, any_ = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if len(b) and 10 * both >= 9 * any_:
            assert set(J.signatures(a, 90, 100).tolist()) & set(J.signatures(b, 90, 100).tolist())


def test_signatures_are_subsets_of_parts():
    """Two sets that differ in one element of a first-level part still share a subset of its parts; single whole parts wouldn't."""
    n1, n2, spare = J.part_plan(1)
    assert (n1, n2, spare) == (2, 3, 3) and J.part_plan(0) == (1, 1, 0)
    for k in range(1, 60):
        n1, n2, spare = J.part_plan(k)
        worst = min(sum((3, 1, 0)[min(d, 2)] for d in split) for split in _spreads(k, n1)) if k < 9 else None
        assert n1 * 2 > k and 0 <= spare < n1 * 3 and worst in (None, spare + 1)
    elements = np.arange(1, 41, dtype=np.uint64) * np.uint64((1 << 64) // 41)
    starts = J._bands(40, 90, 100)
    band = int(np.searchsorted(starts, 40, side="right")) - 1
    expected = 0
    for b in (band, band + 1):
        if b == band or 40 * 100 // 90 >= starts[b]:
            n1, n2, spare = J.part_plan(2 * (starts[b + 1] - 1) * 10 // 190)
            expected += n1 * (3 if n2 > 1 else 1) - spare
    assert len(J.signatures(elements, 90, 100)) == expected


def _spreads(k, n):
    """Ways to deal k differences to n parts, two at most of use in each."""
    for twos in range(min(n, k // 2) + 1):
        for ones in range(min(n - twos, k - 2 * twos) + 1):
            yield [2] * twos + [1] * ones + [0] * (n - twos - ones)


def test_sketches_never_differ_more_than_sets():
    rnd = np.random.default_rng(0)
    for _ in range(300):
        a, b = (np.unique(rnd.integers(0, 1 << 63, int(rnd.integers(1, 300))).astype(np.uint64) * np.uint64(2)) for _ in range(2))
        b = np.unique(np.concatenate([b[: len(b) // 3], a[: len(a) // 2]]))
        words = min(len(J.parity_sketch(a)), len(J.parity_sketch(b))) // 8
        x, y = J.folded(J.parity_sketch(a), words), J.folded(J.parity_sketch(b), words)
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b)) and not np.bitwise_count(x ^ x).any()


def test_lines(docs, rows):
    for chars, n in ((40, 5), (1, 2)):
        same(L.dedup_lines(docs, chars, n), brute_lines(rows, chars, n), ["doc_id", "n_lines", "n_dropped", "kept"])


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = con.sql(queries.ORACLE_SQL[name]).df()
    same(got, [tuple(r) for r in want[got.columns].itertuples(index=False)], got.columns)


def test_line_dedup_runs_no_python(docs):
    plan = L.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mix(docs, rows):
    size = {(r[0], r[3]): len((r[1] or "").encode().split()) for r in rows}
    out = X.plan(docs).collect()
    assert len(out) == len(rows) and all(r.copies <= 3 for r in out)
    totals = {r.source: (r.source_size, r.target) for r in X.targets(docs.select("source", X.n_words(F.col("text")).alias("size"))).collect()}
    assert sum(t for _, t in totals.values()) == pytest.approx(sum(size[r[0], r[3]] for r in rows), rel=1e-9)
    # filling by hand: share by weight, stop at three times the size, share what is left
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted((s for s in totals if s is not None), key=str)) } | {None: (5, 2, 1)[(len(totals) - 1) % 3]}
    left, stopped = sum(s for s, _ in totals.values()), {}
    while over := [s for s in totals if s not in stopped and left * weight[s] / sum(w for k, w in weight.items() if k not in stopped) > 3 * totals[s][0]]:
        for s in over:
            stopped[s] = 3.0 * totals[s][0]
        left = sum(s for s, _ in totals.values()) - sum(stopped.values())
    rest = sum(w for s, w in weight.items() if s not in stopped)
    for s, (_, target) in totals.items():
        assert target == pytest.approx(stopped.get(s, left * weight[s] / rest if rest else 0))
    assert X.mix(docs).exceptAll(X.mix(docs.repartition(3))).count() == 0


def test_mix_with_very_many_sources(docs, monkeypatch):
    few = X.plan(docs)
    monkeypatch.setattr(X, "BROADCAST", 0)
    many = X.plan(docs)
    assert few.exceptAll(many).count() == 0 and few.count() == many.count()


def test_mix_takes_a_source_near_its_target(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + cast(id % 50 as int))").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    out = X.plan(df).join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n"))
    assert all(abs(r.n - r.t) < 0.06 * r.t for r in out.collect())


def test_quality(spark, docs, labels, rows):
    scored = Q.score(docs, labels)
    assert scored.count() == len(rows) and scored.where("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    for empty in (labels.limit(0), labels.where("quality = 1")):
        assert {r.score for r in Q.score(docs, empty).collect()} == {0.5}
    held = {r.doc_id: r.h for r in docs.select("doc_id", Q.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())


def test_quality_tells_held_out_rows_apart(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.1")
    scored = Q.score(read(spark, sf, "documents"), read(spark, sf, "labels")).where(Q.held_out(F.col("doc_id"))).join(read(spark, sf, "labels"), "doc_id").toPandas()
    rank = scored.score.rank()
    good = scored.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.95 and ((scored.score >= 0.5) == good).mean() > 0.95


def test_scores_equal_sizes_recomputed_with_zstandard(docs, labels, rows):
    model = Q.fit(docs, labels)
    machines = [zstandard.ZstdCompressor(level=Q.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (model.good, model.bad)]
    want = []
    for i, text, *_ in rows:
        data = (text or "").encode()
        good, bad = (sum(len(m.compress(data[k : k + Q.PIECE])) for k in range(0, len(data), Q.PIECE)) for m in machines)
        curve = sum(len(data) >= edge for edge in Q.LENGTHS)
        logit = model.intercepts[curve] + model.slopes[curve] * (bad - good) / max(len(data), 1)
        want.append((i, 1 / (1 + math.exp(-max(-35, min(35, logit))))))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.score) for r in Q.score(docs, labels).collect()), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-9)


def test_training_pieces_are_whole_texts(rows):
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(rows), pa.int32()), pa.array([r[1] for r in rows])], names=["quality", "text"])
    for out, (_, text, *_) in zip(Q._pieces(iter([batch])), rows, strict=True):
        assert b"".join(out.column("piece").to_pylist()) == (text or "").encode()


def test_labels_of_held_out_rows_are_never_read(docs, labels):
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.score(docs, labels), Q.score(docs, flipped)
    assert a.exceptAll(b).count() == 0


def near_texts():
    """Two unlike texts and a near copy of each."""
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "ab")
    return one, two, one + " more", two + " more"


def test_a_copy_without_an_id_does_not_sign_for_the_others(spark):
    one, _, near, _ = near_texts()
    rows = [(None, one), (6, one), (5, near)]
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 3, 90, 100)
    same(got, brute_jaccard(rows, 3, 90, 100), ["doc_id", "n_shingles", "component_id"])
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(None, None), (6, 5), (5, 5)}


def test_rows_that_share_an_id_link_by_their_own_texts(spark):
    one, two, near_one, near_two = near_texts()
    rows = [(5, one), (5, two), (3, near_one), (7, near_two)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        same(J.jaccard_components(df, 3, 90, 100), brute_jaccard(order, 3, 90, 100), ["doc_id", "n_shingles", "component_id"])
        assert sorted(tuple(r) for r in J.one_of_each(df, 3, 90, 100).collect()) == sorted([(5, two), (3, near_one)])


def secret_rows(n=60):
    rnd = random.Random(1)
    hexes = lambda k: "".join(rnd.choice("0123456789abcdef") for _ in range(k))
    rows = [(i, f'the quick brown fox token = "{hexes(40)}" jumps over antidisestablishmentarianism and 4111111111111111 there', "en", "s", 1) for i in range(n)]
    return [*rows, (100, None, "en", "s", 1), (101, "", "en", "s", 1), (0, rows[0][1], "en", "s", 1), (102, "é" * 50 + "x" * 20_000, "en", "s", 1), (None, f"bare {hexes(40)} here", "en", "s", 1)]


def test_secrets(spark):
    rows = secret_rows()
    df = spark.createDataFrame(rows, DOCS)
    out = S.scan(df)
    secret = out.where("is_secret").collect()
    assert len(secret) == 61 and all(r.end - r.start == 40 for r in secret) and out.count() == 3 * 61 + 2
    found = S.candidates(df).limit(0)
    assert S.classify(S.candidates(df), found.withColumn("label", F.lit(1))).where("probability < 1").count() == 0
    assert S.scan(df.limit(0)).count() == 0
    wide = df.withColumns({c: F.lit(c) for c in ("near", "features", "label", "digest", "start", "w")})
    assert S.scan(wide).exceptAll(out).count() == 0


def test_secret_candidates_equal_brute_force(spark):
    rows = secret_rows(20)
    docs = spark.createDataFrame(rows, DOCS)
    surprise, words = S.corpus_model(docs)

    def longest_first(text):
        at = inside = 0
        while at < len(text):
            n = next((n for n in range(min(15, len(text) - at), 2, -1) if text[at : at + n] in words), 0)
            inside, at = inside + n, at + (n or 1)
        return inside / len(text)

    want = []
    for doc, text, *_ in rows:
        for m in S.CANDIDATE.finditer(text or ""):
            c = m.group()
            kinds = [1 if x.isdigit() else 2 if x.isupper() else 3 if x.islower() else 0 for x in c]
            pairs = [surprise[ord(a), ord(b)] for a, b in zip(c.lower(), c.lower()[1:], strict=False)]
            want.append((doc, m.start(), m.end(), len(c), len(set(kinds)), sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / (len(c) - 1), sum(pairs) / len(pairs), longest_first(c.lower())))
    pick = [S.FEATURES.index(f) for f in ("length", "kinds", "switches", "surprise", "coverage")]
    got = [(r.doc_id, r.start, r.end, *(r.features[i] for i in pick)) for r in S.candidates(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:3])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=1e-9)


def test_findings_decide_what_is_a_secret(spark):
    """The forest learns from the findings it is given: labelled the other way round, it answers the other way round."""
    df = spark.createDataFrame(secret_rows(), DOCS)
    found = S.candidates(df).cache()
    flipped = S.assigned_findings(found).withColumn("label", 1 - F.col("label"))
    secret = S.scan(df, flipped).where("is_secret").collect()
    assert secret and all(r.end - r.start != 40 for r in secret if r.doc_id not in (None, 102))


def test_corpus_model_counts_all_whole_texts(spark):
    late = spark.createDataFrame([(-1, "x " * 15_000 + "zyzzyva " * 50, "en", "s", 1), (-2, None, "en", "s", 1)], DOCS)
    pad = spark.range(2500).select(F.col("id").alias("doc_id"), F.concat(F.lit("Quick "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"), F.lit("qv")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    docs = late.select("doc_id", "text").union(pad.select("doc_id", "text"))
    bare = [S.CANDIDATE.sub(" ", r.text or "").lower() for r in docs.collect()]
    found = Counter(w for t in bare for w in re.findall(r"[^\W\d_]+", t) if re.fullmatch("[a-z]{3,}", w))
    surprise, words = S.corpus_model(docs)
    assert words == set(found) and "zyzzyva" in words
    pairs = np.ones((128, 128))
    for w, n in found.items():
        for a, b in zip(w, w[1:], strict=False):
            pairs[ord(a), ord(b)] += n
    assert np.allclose(surprise, -np.log2(pairs / pairs.sum(axis=1, keepdims=True)))


def test_no_letters_of_a_secret_are_counted_or_kept(spark):
    token = "eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0NTY3ODkw.abcdefghSECRETuvwxyz"
    rows = [(i, f"naïveword key {token} internationalizations end", "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    _, words = S.corpus_model(docs)
    assert words == {"key", "end"}  # neither parts of candidates, nor of words with other letters
    assert {w for r in S.candidates(docs).collect() for w in r.near} <= words


def test_neighbours_are_whole_words_at_any_distance():
    text = "alpha beta" + " " * 90 + "'" + "k9" * 10 + "'" + "." * 200 + "gamma Delta4 word " + "x" * 20 + " far"
    beside = S.Neighbours(text)
    every = frozenset(beside.words)
    assert beside.beside(text.index("k9"), every) == ["alpha", "beta", "gamma", "delta", "word"] and beside.beside(text.index("xxx"), every) == ["gamma", "delta", "word", "far"]


def test_hash_samples_are_never_empty(spark):
    """Rows whose hashes are all alike, or lie anywhere, at every size."""
    from gridloom.llm.tables import hash_sample

    df = spark.range(3000)
    for key in (F.lit((1 << 30) - 1).cast("long"), F.lit(0).cast("long"), F.xxhash64("id"), F.when(F.col("id") < 5, 1).otherwise(-1).cast("long")):
        assert hash_sample(df, key, 50).count() == 50 and hash_sample(df, key, 5000).count() == 3000
    want = sorted((h % (1 << 30), h) for h in (r[0] for r in df.select(F.xxhash64("id")).collect()))[:50]
    assert sorted((r[1] % (1 << 30), r[1]) for r in hash_sample(df.select("id", F.xxhash64("id").alias("h")), F.col("h"), 50).collect()) == want


def test_letter_pairs_come_from_words_outside_the_dictionary_too(spark, monkeypatch):
    monkeypatch.setattr(S, "WORDS", 1)
    surprise, words = S.corpus_model(spark.createDataFrame([(1, "the the zyx")], "doc_id long, text string"))
    assert words == {"the"} and surprise[ord("z"), ord("y")] == surprise[ord("y"), ord("x")] < surprise[ord("z"), ord("a")]


@pytest.fixture(scope="module")
def pieces():
    return SP.Pieces(open(SP.MODEL, "rb").read())  # noqa: SIM115


def scanned(pieces, text, chunk):
    """The scan of one text, chunk by chunk, as the tasks do it."""
    normal = pieces.normal(text)
    count = -(-len(normal) // chunk)
    parts = []
    for i in range(count):
        left, right = i * chunk, min(len(normal), (i + 1) * chunk)
        parts.append((left, right, *SP._ends(pieces, i, count, left, right, normal)))
    matrices = [SP.transfer(pieces, normal, a, b, begin, end) for a, b, begin, end in parts]
    matrices[-1] = matrices[-1].max(axis=1, keepdims=True)
    inner = SP.best_states(matrices) if count > 1 else []
    out = []
    for i, (a, b, begin, end) in enumerate(parts):
        start = begin[inner[i - 1] if i else 0]
        last = end[inner[i]] if i < count - 1 else end[int(np.argmax(SP.transfer(pieces, normal, a, b, [start], end)[0]))]
        out += SP.trace(pieces, normal, a, b, start, last)
    return out


def test_scan_equals_the_library(pieces, rows):
    rnd = random.Random(6)
    library = sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    texts = [r[1][:900] for r in rows if r[1]][:25] + ["  two  spaces   ", "𝄞" * 90, "x" * 200, "ab" * 150]
    texts += ["".join(rnd.choice(" aabé日the\n  xing") for _ in range(250)) for _ in range(10)] + [t.replace(" ", "") for t in texts[:8]]
    for text in texts:
        for chunk in (37, 120):
            assert scanned(pieces, text, chunk) == library.encode(text)


def test_max_plus_products_are_associative():
    rnd = np.random.default_rng(0)
    a, b, c = (rnd.random(s) for s in ((3, 4), (4, 2), (2, 5)))
    np.testing.assert_allclose(SP.compose(SP.compose(a, b), c), SP.compose(a, SP.compose(b, c)))


def test_encode_decode(wide, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    out = SP.decode(SP.encode(wide, giant=20_000))
    assert set(out.columns) == {*wide.columns, "n_chunks", "decoded"}
    got = out.collect()
    assert len(got) == len(rows) and any(r.n_chunks > 1 for r in got)
    for r in got:
        assert list(r.ids) == library.encode(r.text or "") and r.decoded == (r.text or "") and r.size == "size"
    assert SP.encode(wide, giant=20_000, check=True).where("not round_trip").count() == 0


def test_pass_through_columns(wide, labels):
    for out in (Q.accepted(wide, labels), L.without_common_lines(wide), J.one_of_each(wide, 3, 90, 100), X.mix(wide)):
        assert out.columns == wide.columns
        assert out.count() > 0 and all(out.where(f"`{c}` <> '{c}' or `{c}` is null").count() == 0 for c in EXTRA)


def test_empty_tables(spark, docs, labels):
    none = docs.limit(0)
    for out in (
        R.suffix_dedup(none), R.repeat_groups(none), P.phrase_dedup(none), J.jaccard_components(none), L.dedup_lines(none), X.plan(none), X.mix(none), Q.score(none, labels),
        Q.accepted(none, labels), SP.decode(SP.encode(none)), J.one_of_each(none), L.without_common_lines(none),
    ):
        assert out.count() == 0


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (7, 8), (8, 7)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {i: find(i) for a, b in edges if a != b for i in (a, b)}
    assert {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        m = rnd.random((rnd.integers(1, 9), rnd.integers(1, 9))) < rnd.random() * 0.6
        group = lambda edges: _groups(edges, *m.shape)  # noqa: E731, B023
        found = forest(m)
        assert all(m[i, j] for i, j in found) and group(found) == group(np.argwhere(m).tolist())


def _groups(edges, n, k):
    name = list(range(n + k))
    for a, b in edges:
        x, y = name[a], name[n + b]
        name = [min(x, y) if v in (x, y) else v for v in name]
    return name
