"""Quality classifier from compressed sizes.

Two zstandard dictionaries are trained, one from good and one from bad labelled
text. A text is compressed piece by piece under both; the difference of the sums
normalised by the text's own size, (bad - good) / bytes, says which text it
resembles (a text that just repeats itself resembles neither: both sums are
small), and a logistic curve of the difference, fitted on other labelled rows,
turns it into a probability. A text's length chooses its curve, as differences of short texts
scatter more; nothing but the difference enters it.

Fitting uses a bounded sample: ``per_class`` labelled rows of each class for the
dictionaries and as many for the curves, the ones with the smallest hashes, and
``PIECES`` pieces of each class's whole texts, picked by their hashes. Scoring
reads every byte of every text.

A null or empty text compresses to nothing: difference 0, and the value there of
the curve for short texts. Labels other than 0 and 1, and rows without a label,
aren't learnt from; a doc_id labelled twice counts once, or with both labels if
they differ. Rows that share a doc_id are scored by their own texts. Ties of
hashes fall by doc_id. With no good or no bad rows to learn from, every score is
0.5. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .tables import hash_sample, materialize, ship

PIECE = 512
LEVEL = 3
DICT_BYTES = 112_640
PER_CLASS = 1500
#: Pieces of each class that its dictionary is trained on: ten megabytes, some ninety times its size.
PIECES = 20_000
#: Lengths in bytes at which another curve begins.
LENGTHS = (64, 128, 256, 1024, 4096)


class Model(NamedTuple):
    good: bytes
    bad: bytes
    #: one curve for each range of lengths: the probability at difference 0, as a logit, and the slope
    intercepts: tuple[float, ...]
    slopes: tuple[float, ...]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    extra = {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **extra)


def compressed_sizes(text: memoryview, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[int, int]:
    g = b = 0
    for at in range(0, len(text), PIECE):
        piece = text[at : at + PIECE]
        g += len(good.compress(piece))
        b += len(bad.compress(piece))
    return g, b


def difference(size: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return (bad - good) / np.maximum(size, 1)


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, precision: np.ndarray) -> np.ndarray:
    """Newton's method on the penalised likelihood of one variable: intercept and slope, drawn towards ``prior``."""
    x = np.stack([np.ones(len(x)), x], axis=1)
    w, penalty = prior.copy(), np.diag(precision)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ (w - prior))
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def curves(quality: np.ndarray, size: np.ndarray, gap: np.ndarray) -> tuple[list[float], list[float]]:
    """Intercept and slope for each range of lengths, drawn towards those of all rows where a range has few."""
    scale = max(float(np.abs(gap).max()), 1e-9)
    common = _logistic(gap / scale, quality, np.zeros(2), np.array([1e-6, 1e-3]))
    which = np.searchsorted(LENGTHS, size, side="right")
    found = [_logistic(gap[which == k] / scale, quality[which == k], common, np.array([0.1, 0.1])) for k in range(len(LENGTHS) + 1)]
    return [float(a) for a, _ in found], [float(b) / scale for _, b in found]


def probability(model: Model, size: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    which = np.searchsorted(LENGTHS, size, side="right")
    logit = np.array(model.intercepts)[which] + np.array(model.slopes)[which] * difference(size, good, bad)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts -> their pieces, each with a hash of its content and place."""
    for batch in batches:
        raw, at = H.text_buffers(batch.column("text"))
        quality = batch.column("quality").to_pylist()
        for i in range(batch.num_rows):
            view = memoryview(raw)[at[i] : at[i + 1]]
            pieces = [bytes(view[k : k + PIECE]) for k in range(0, len(view), PIECE)]
            keys = [xxhash.xxh3_64_intdigest(p, seed=k) >> 1 for k, p in enumerate(pieces)]
            yield pa.RecordBatch.from_arrays([pa.array([quality[i]] * len(pieces), pa.int32()), pa.array(keys, pa.int64()), pa.array(pieces, pa.binary())], names=["quality", "key", "piece"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """Train on at most 2 * per_class rows of each class; None if a class has no rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id")
    picked = hash_sample(known.where("quality = 0"), order, 2 * per_class).union(hash_sample(known.where("quality = 1"), order, 2 * per_class))
    # at most 4 * per_class rows of a few numbers: a proven bound
    picked = picked.withColumn("first", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2)) == 0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(picked.where("first")), "doc_id").select("quality", "text")
    pieces = materialize(rows.mapInArrow(_pieces, "quality int, key long, piece binary"))
    dictionaries = {}
    for q in (0, 1):
        sample = sorted(bytes(r.piece) for r in hash_sample(pieces.where(F.col("quality") == q), F.col("key"), PIECES).select("piece").collect())
        if not sample:
            return None
        try:
            dictionaries[q] = zstandard.train_dictionary(DICT_BYTES, [p for p in sample if len(p) >= 8]).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too little text for a trained one: its end serves as it is
            dictionaries[q] = b"".join(sample)[-DICT_BYTES:]
    # the curves are fitted on whole texts, as they are scored; a few numbers a row come back, of rows that repeat ids a bounded number
    shared = docs.sparkSession.sparkContext.broadcast((dictionaries[1], dictionaries[0]))
    whole = texts.join(F.broadcast(picked.where("not first")), "doc_id").select("quality", "text", F.xxhash64("doc_id", "text").alias("key"))
    sizes = materialize(whole.mapInArrow(_sizes(shared), "quality int, size long, good long, bad long, key long"))
    found = sorted(tuple(r) for q in (0, 1) for r in hash_sample(sizes.where(F.col("quality") == q), F.col("key"), 2 * per_class).drop("key").collect())
    table = np.array(found, dtype=np.float64).reshape(-1, 4)
    quality = table[:, 0]
    if len(set(quality.tolist())) < 2:
        return None
    intercepts, slopes = curves(quality, table[:, 1], difference(*table[:, 1:].T))
    # classes were drawn alike; the odds they really have among the labelled rows come back in the intercept
    counts, drawn = dict(known.groupBy("quality").count().collect()), quality.mean()
    odds = np.log(counts[1] / counts[0]) - np.log(drawn / (1 - drawn))
    return Model(dictionaries[1], dictionaries[0], tuple(a + float(odds) for a in intercepts), tuple(slopes))


def _sizes(shared):
    """Whole texts -> their length, and their compressed sizes under a (good, bad) pair of dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = map(_compressor, shared.value)
        for batch in batches:
            raw, at = H.text_buffers(batch.column("text"))
            view = memoryview(raw)
            sizes = np.array([compressed_sizes(view[a:b], good, bad) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(np.diff(at)), pa.array(sizes[:, 0]), pa.array(sizes[:, 1]), batch.column("key")], names=["quality", "size", "good", "bad", "key"])

    return run


def _score(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        good, bad = (_compressor(model.good), _compressor(model.bad)) if model else (None, None)
        for batch in batches:
            raw, at = H.text_buffers(batch.column("text"))
            if model:
                view = memoryview(raw)
                sizes = np.array([compressed_sizes(view[a:b], good, bad) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], dtype=np.float64).reshape(-1, 2)
                score = probability(model, np.diff(at), sizes[:, 0], sizes[:, 1])
            else:
                score = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(score)], names=[*columns, "_score"])

    return run


def score(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, score) for every row: the probability that its label is 1."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels, per_class))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_score(shared, ["doc_id"]), "doc_id long, _score double").withColumnRenamed("_score", "score")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """The rows that score ``threshold`` or more, with the input's columns."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels, per_class))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_score(shared, ["row"]), rows.select("row").withColumn("_score", F.lit(0.0)).schema)
    return scored.where(F.col("_score") >= threshold).select("row.*")
