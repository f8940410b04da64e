"""Secret scans whose false positives a random forest removes.

Candidates are long runs of key-like characters. Each is described by its
length, its character transitions (how often the kind of character changes, and
how unlikely its letter pairs are in the corpus's words), how much of it common
words cover, whether it stands in a path or URL, and by its neighbouring words:
how many of them are common, and how often each was near a secret among the
labelled findings. A random forest trained on labelled findings gives the
probability that the candidate is a secret.

Findings are an input. ``assigned_findings`` makes them where a corpus has none,
from the punctuation around a candidate, which the forest isn't given: what is
assigned and quoted is a secret, what stands bare in running text is none.

Letter pairs and words are counted over all whole texts; the broadcast dictionary
holds the 5000 commonest words (``WORDS``). Candidates are left out of both, as they
are of the neighbours, so that no letters of a secret come into a table. The forest is fitted on at most
``per_class`` labelled findings of each class, those with the smallest hashes.
Candidates are sought in every whole text, however long they are themselves. No
candidate is written anywhere: tables hold places, digests and features.

Null and empty texts have no candidates. The same secret found twice is two
findings. Without findings of both classes nothing is removed (probability 1).
Rows that share a doc_id are scanned one by one; ties of hashes fall by place and
digest. An empty table gives no rows. Other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import hash_sample, materialize, ship

CANDIDATE = re.compile(r"[A-Za-z0-9+/=_\-]{16,}")
WORD = re.compile(r"[^\W\d_]+")
FEATURES = ("length", "kinds", "switches", "digits", "upper", "entropy", "surprise", "coverage", "path", "words_near")
#: Size of the broadcast dictionary of common words.
WORDS = 5000
PER_CLASS = 5000
#: Neighbours looked at on each side, and labelled findings beside which a word must stand for its rate to count (so 3000 rates at most).
NEAR, OFTEN = 3, 20
_KIND = np.zeros(128, dtype=np.int64)
for _a, _b, _k in ((48, 58, 1), (65, 91, 2), (97, 123, 3)):
    _KIND[_a:_b] = _k


def corpus_model(docs: DataFrame) -> tuple[np.ndarray, frozenset[str]]:
    """-log2 of each letter pair's frequency in all words of all whole texts, and the WORDS commonest words.

    Words are whole runs of letters, and stand outside all candidates: no part of a secret is counted.
    """
    bare = F.lower(F.regexp_replace("text", F.lit(CANDIDATE.pattern), F.lit(" ")))
    found = docs.select(F.explode(F.regexp_extract_all(bare, F.lit(r"(?<!\p{L})([a-z]{3,})(?!\p{L})"))).alias("w"))
    words = materialize(found.groupBy("w").count())
    top = words.orderBy(F.desc("count"), "w").limit(WORDS).collect()
    pair = F.explode(F.expr("transform(sequence(1, length(w) - 1), i -> substring(w, i, 2))")).alias("pair")
    pairs = np.ones((128, 128))
    for r in words.select(pair, "count").groupBy("pair").agg(F.sum("count").alias("n")).collect():  # 26 * 26 rows at most
        pairs[ord(r.pair[0]), ord(r.pair[1])] += r.n
    return -np.log2(pairs / pairs.sum(axis=1, keepdims=True)), frozenset(r.w for r in top)


def dictionary(words: frozenset[str]) -> ahocorasick.Automaton | None:
    if not words:
        return None
    out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for w in words:
        out.add_word(w)
    out.make_automaton()
    return out


def coverage(text: str, machine: ahocorasick.Automaton | None) -> float:
    """Share of the characters inside common words that don't overlap, longest first from the left."""
    return sum(n for _, n in machine.iter_long(text.lower())) / max(len(text), 1) if machine else 0.0


class Neighbours:
    """The words of a text that stand outside all candidates."""

    def __init__(self, text: str) -> None:
        found = list(WORD.finditer(CANDIDATE.sub(lambda m: " " * len(m.group()), text)))
        self.at, self.words = [m.start() for m in found], [m.group().lower() for m in found]

    def beside(self, start: int, words: frozenset[str]) -> list[str]:
        """The common ones among the NEAR words on each side of a candidate, however far; others aren't kept, as they may be secrets too."""
        i = bisect_left(self.at, start)
        return [w for w in self.words[max(0, i - NEAR) : i + NEAR] if w in words]


def describe(text: str, start: int, end: int, surprise: np.ndarray, machine: ahocorasick.Automaton | None, near: list[str]) -> list[float]:
    found = text[start:end]
    codes = np.frombuffer(found.encode("ascii"), dtype=np.uint8)
    kinds = _KIND[codes]
    share = np.bincount(codes) / len(codes)
    share = share[share > 0]
    lower = np.frombuffer(found.lower().encode("ascii"), dtype=np.uint8)
    before = text[max(0, start - 12) : start]
    return [
        float(len(found)),
        float(np.count_nonzero(np.bincount(kinds))),
        float((kinds[1:] != kinds[:-1]).mean()),
        float((kinds == 1).mean()),
        float((kinds == 2).mean()),
        float(-(share * np.log2(share)).sum()),
        float(surprise[lower[:-1], lower[1:]].mean()),
        coverage(found, machine),
        float(found.count("/") > 1 or "://" in before or before[-1:] in ("/", ".", "@") and before != ""),
        float(len(near)),
    ]


def is_assigned(text: str, start: int, end: int) -> int | None:
    """1 for a candidate assigned in quotes, 0 for one between blanks, None for any other."""
    if re.search(r"[=:]\s*[\"']$", text[max(0, start - 12) : start]) and text[end : end + 1] in ("'", '"') and end < len(text):
        return 1
    return 0 if (start == 0 or text[start - 1].isspace()) and (end == len(text) or text[end].isspace() or text[end] in ".,;!?") else None


_COLUMNS = {"doc_id": pa.int64(), "start": pa.int64(), "end": pa.int64(), "digest": pa.string(), "assigned": pa.int32(), "near": pa.list_(pa.string()), "features": pa.list_(pa.float64())}


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surprise, words = shared.value
        machine = dictionary(words)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if (text := text.as_py()) is None:
                    continue
                beside = None
                for m in CANDIDATE.finditer(text):
                    a, b = m.span()
                    beside = beside or Neighbours(text)
                    near = beside.beside(a, words)
                    digest = hashlib.sha256(m.group().encode()).hexdigest()[:16]
                    out.append((doc, a, b, digest, is_assigned(text, a, b), near, describe(text, a, b, surprise, machine, near)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(_COLUMNS.values())], names=list(_COLUMNS))

    return run


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start, end (code points), digest, assigned, near, features."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(corpus_model(docs))
    return docs.mapInArrow(_scan(shared), "doc_id long, start long, end long, digest string, assigned int, near array<string>, features array<double>")


def assigned_findings(found: DataFrame) -> DataFrame:
    """Candidates whose punctuation labels them: 1 assigned in quotes, 0 bare in running text."""
    return found.where("assigned is not null").withColumn("label", F.col("assigned"))


def classify(found: DataFrame, findings: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``found`` with probability; findings: rows of ``found`` with a label, 1 for a secret and 0 for a false positive."""
    order = F.xxhash64("doc_id", "start", "digest")
    of = lambda q: hash_sample(findings.where(F.col("label") == q).select("doc_id", "start", "digest", "near", "features", "label"), order, per_class)
    sample = materialize(of(0).union(of(1)).repartition(1))
    if sample.select("label").distinct().count() < 2:
        return found.withColumn("probability", F.lit(1.0))
    # words beside at most 2 * per_class findings, six each: a bounded table
    rates = sample.select(F.explode(F.array_distinct("near")).alias("w"), "label").groupBy("w").agg(F.avg("label").alias("rate"), F.count(F.lit(1)).alias("n"))
    rates = {r.w: float(r.rate) for r in rates.where(F.col("n") >= OFTEN).collect()}
    rate = F.create_map(*(F.lit(x) for pair in sorted(rates.items()) for x in pair)) if rates else None
    nearest = F.array_max(F.transform("near", lambda w: F.coalesce(F.element_at(rate, w), F.lit(0.0)))) if rates else F.lit(0.0)
    vector = array_to_vector(F.concat("features", F.array(F.coalesce(nearest, F.lit(0.0)))))
    model = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=40, maxDepth=8, seed=7).fit(sample.select(vector.alias("x"), F.col("label").cast("double").alias("label")))
    scored = model.transform(found.withColumn("x", vector))
    return scored.withColumn("probability", vector_to_array("probability")[1]).select(*found.columns, "probability")


def scan(docs: DataFrame, findings: DataFrame | None = None, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, start, end, digest (of the candidate, which isn't shown), probability, is_secret.

    findings: rows of ``candidates`` with a label; by default those of ``assigned_findings``.
    """
    found = materialize(candidates(docs))
    scored = classify(found, assigned_findings(found) if findings is None else findings, per_class)
    return scored.select("doc_id", "start", "end", "digest", "probability", (F.col("probability") >= 0.5).alias("is_secret"))
