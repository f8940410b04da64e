"""Cross-tokenizer alignment against the two libraries and plain loops."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import queries
from gridloom.llm import token_alignment as T

from .fixtures import DOCS, EXTRA, documents

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def brute(rows):
    """(columns of each row, pair counts): every A and B token, byte range against byte range."""
    one = Tokenizer.from_file(T.BYTES_MODEL)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=T.MODEL)
    letters = T.byte_letters()
    made = []
    for doc_id, text, *_ in rows:
        raw = (" " + (text or "")).encode()
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        parts_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
        parts_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            made.append((doc_id, [], [], [], ""))
            continue
        spans_a, spans_b = [], []
        for parts, spans in ((parts_a, spans_a), (parts_b, spans_b)):
            at = 0
            for x in parts:
                spans.append((at, at + len(x)))
                at += len(x)
        links, low = [], 0
        for i, (s, e) in enumerate(spans_a):
            while spans_b[low][1] <= s:
                low += 1
            j = low
            while j < len(b) and spans_b[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, i, j = [], 0, 0
        for cut in cuts:
            left, right = [], []
            while i < len(a) and spans_a[i][1] <= cut:
                left.append(str(a[i]))
                i += 1
            while j < len(b) and spans_b[j][1] <= cut:
                right.append(str(b[j]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        made.append((doc_id, a, b, links, ";".join(groups)))
    counts = Counter(link for m in made for link in m[3])
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = [(d, len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), g) for d, a, b, links, g in made]
    return out, counts


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


AWKWARD = [
    (200, "a literal ▁ mark", "en", "s", 1), (201, "two  spaces\n\n and\tothers \n", "en", "s", 1), (202, " leading", "en", "s", 1), (203, "trailing ", "en", "s", 1), (204, " ", "en", "s", 1),
    (205, "special <|endoftext|> </s> <s> <unk> <0x41>", "en", "s", 1), (206, "日本語 и русский 😀 x y z", "xx", "s", 1), (207, "é́ \x1c\x85 \x00nul", "xx", "s", 1),
    (208, "don't we'll I'm  they've", "en", "s", 1), (209, "a" * 5000, "en", "s", 1), (210, "\n \n  x \n y", "en", "s", 1), (211, "x▁ y", "en", "s", 1), (212, "1234567 89,000.5", "en", "s", 1),
]


@pytest.fixture(scope="module")
def rows():
    return documents(n=40) + AWKWARD


@pytest.mark.parametrize(("links", "fan_in", "words"), [(1 << 21, 64, 1 << 18), (300, 2, 40)])
def test_alignment_equals_the_libraries(spark, rows, monkeypatch, links, fan_in, words):
    """Also with many runs, several merges a radix, and a table of words that is cleared again and again."""
    for name, value in (("FAN_IN", fan_in), ("RUN_LINKS", links), ("WORDS", words)):
        monkeypatch.setattr(T, name, value)
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in EXTRA}).repartition(3)
    want, counts = brute(rows)
    corpus = T.spill(df)
    assert corpus.salts == (1 if fan_in == 64 else 2)
    found = T.pair_counts(corpus)
    assert {(r.a_id, r.b_id): r["count"] for r in found.collect()} == counts
    assert ordered(tuple(r[c] for c in COLUMNS) for r in T.align(df).select(COLUMNS).collect()) == ordered(want)


def test_runs_and_merges_in_small_parts(rows, monkeypatch):
    """Inside tasks: words in a small table, several runs, counts in several blocks."""
    monkeypatch.setattr(T, "WORDS", 30)
    table = T.word_table.__wrapped__(open(T.BYTES_MODEL, "rb").read(), open(T.MODEL, "rb").read())
    want, counts = brute(rows)
    got = Counter()
    for at in range(0, len(rows), 5):
        some = [r[1] for r in rows[at : at + 5]]
        found, sizes = table.of(some)
        assert len(sizes) == len(some) and len(table.known) >= 0
        pairs, _ = table.pairs(found)
        for radix, packed, _ in T.runs_of(pairs << T.DOC_BITS, table.layout) if len(pairs) else []:
            step, _, n = T.unpack(packed, *T.PAIRS)
            a, b = table.layout.ids(radix, np.cumsum(step))
            got.update(dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)))
    assert got == counts


def test_digest_and_empty_tables(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    texts = {r.doc_id: r.groups for r in T.align(df.where("doc_id >= 200")).collect()}
    hashed = {r.doc_id: r.groups for r in T.align(df.where("doc_id >= 200"), groups="sha256").collect()}
    assert hashed == {i: hashlib.sha256(g.encode()).hexdigest() if g else "" for i, g in texts.items()}
    assert T.align(df.limit(0)).collect() == [] and {r.n_a for r in T.align(df.where("text is null")).collect()} == {0}


def test_query_over_a_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute(rows)[0]]
    got = queries.op13_token_alignment(spark, sf_dir)
    assert got.columns == [*COLUMNS[:-1], "groups_sha256"]
    assert ordered(map(tuple, got.collect())) == ordered(want)
