"""Finding what repeats across a corpus without moving the whole corpus.

Both substring operators ask which windows (400 bytes, 35 words) start in more
than one place. Sending every window through a shuffle would move the corpus
many times over. Instead each window is charged to its *anchor*, the gram with
the smallest hash inside it: equal windows have equal anchors, so a window can
only repeat if its anchor occurs twice. Consecutive windows with one anchor
form a *segment*; segments are counted by content, and only the distinct
segments of anchors that occur twice go on to the exact step, one copy each
with its multiplicity.

All distinct segments of an anchor meet in one block. An anchor with more than
``HOT`` of them is dealt again: its segments become the texts of a next round
whose anchors are longer grams, up to the window itself, where an anchor has one
distinct segment. Every round ends in the same exact step.

A row is told apart by a 128-bit hash of its doc_id (or that it has none) and
its text; a segment by a 128-bit hash of its units. Repeated rows are counted as the
separate texts they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .tables import materialize, row_identity, ship, skew_join

_POS = np.uint64((1 << 24) - 1)
#: Units of one text that are handled at a time; longer texts are cut, overlapping by a window.
SLICE = 1 << 20
#: Distinct segments that meet in one block (two megabytes of bytes); an anchor with more is dealt by longer grams.
HOT = 3000


class Units(NamedTuple):
    """What a window is made of: ``window`` units long, anchored at grams of ``grams`` units, one length a round."""

    window: int
    grams: tuple[int, ...]
    #: bytes of a text -> 64-bit value of each unit
    values: Callable[[np.ndarray], np.ndarray]


def gram_lengths(window: int, first: int) -> tuple[int, ...]:
    """Doubling from ``first``; the window itself is the last."""
    out = [max(1, min(first, window))]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return tuple(out)


def segments(values: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, the halves of a 128-bit hash of the content, first unit, number of windows) of each segment of one text."""
    total = len(values) - window + 1
    for at in range(0, total, SLICE):
        part = values[at : at + SLICE + window - 1]
        n = len(part) - window + 1
        total_hash = H.running(part)
        begin = np.arange(len(part) - gram + 1)
        grams = H.range_hashes(total_hash, begin, begin + gram)
        packed = (grams & ~_POS) | begin.astype(np.uint64)
        place = (H.sliding_min(packed, window - gram + 1) & _POS).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        windows = np.diff(first, append=n)
        bounds = zip((first * 8).tolist(), ((first + windows + window - 1) * 8).tolist(), strict=True)
        memory = memoryview(np.ascontiguousarray(part)).cast("B")
        content = np.frombuffer(b"".join([xxhash.xxh3_128_digest(memory[a:b]) for a, b in bounds]), dtype=np.int64).reshape(-1, 2)
        yield grams[place[first]], content[:, 0], content[:, 1], first + at, windows


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with the two columns that tell a row apart."""
    ship(docs.sparkSession)
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc.alias("doc_id"), text.alias("text"), *(c.alias(f"r{k}") for k, c in enumerate(row_identity(doc, text), 1)))


_FOUND = ("anchor", "c1", "c2", "r1", "r2", "first", "windows", "copies")


def _occurrences(units: Units, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = H.text_buffers(batch.column("text"))
            given = [batch.column(c).to_numpy() for c in ("r1", "r2", "copies")]
            found: list[list[np.ndarray]] = [[] for _ in _FOUND]
            held = 0
            for i in range(batch.num_rows):
                for anchor, c1, c2, first, windows in segments(units.values(raw[at[i] : at[i + 1]]), units.window, gram):
                    r1, r2, copies = (np.full(len(anchor), x[i]) for x in given)
                    for column, x in zip(found, (anchor, c1, c2, r1, r2, first, windows, copies), strict=True):
                        column.append(x)
                    held += len(anchor)
                if held > 200_000 or (held and i == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in found], names=list(_FOUND))
                    found, held = [[] for _ in _FOUND], 0

    return run


def occurrences(texts: DataFrame, units: Units, gram: int) -> DataFrame:
    """One row for each segment of each text (r1, r2, copies, text)."""
    return texts.select("r1", "r2", "copies", "text").mapInArrow(_occurrences(units, gram), ", ".join(f"{c} long" for c in _FOUND))


def recurring(found: DataFrame) -> DataFrame:
    """Distinct segments whose anchor occurs at least twice, with their multiplicity and one place that holds them."""
    # the row with the smallest hash holds it, so that segments shared by the same rows are cut from one
    distinct = found.groupBy("anchor", "c1", "c2").agg(
        F.sum("copies").alias("copies"),
        F.min("r1").alias("r1"),
        F.min_by("r2", "r1").alias("r2"),
        F.min_by("first", "r1").alias("first"),
        F.min("windows").alias("windows"),
    )
    by = distinct.groupBy("anchor").agg(F.sum("copies").alias("n"), (F.count(F.lit(1)) > HOT).alias("hot"))
    return distinct.join(by.where("n > 1").select("anchor", "hot"), "anchor")


_BODY = "anchor long, c1 long, c2 long, copies long, windows int, body binary"


def bodies(texts: DataFrame, picked: DataFrame, cut) -> DataFrame:
    """The distinct segments' own units, cut from one text that holds each."""
    lists = picked.groupBy("r1", "r2").agg(F.collect_list(F.struct("anchor", "c1", "c2", "copies", "first", "windows")).alias("_cuts"))
    return texts.select("r1", "r2", "text").join(lists, ["r1", "r2"]).select("text", "_cuts").mapInArrow(cut, _BODY)


def cutter(piece: Callable[[np.ndarray, np.ndarray, np.ndarray], list[bytes]]):
    """For ``bodies``: piece(bytes of a text, first units, numbers of windows) -> the segments' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = H.text_buffers(batch.column("text"))
            cuts = batch.column("_cuts")
            edges = cuts.offsets.to_numpy()
            flat = cuts.values
            columns = {k: flat.field(k).to_numpy(zero_copy_only=False) for k in ("anchor", "c1", "c2", "copies", "first", "windows")}
            for i in range(batch.num_rows):
                own = slice(edges[i], edges[i + 1])
                pieces = piece(raw[at[i] : at[i + 1]], columns["first"][own], columns["windows"][own])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(columns[k][own]) for k in ("anchor", "c1", "c2", "copies")), pa.array(columns["windows"][own].astype(np.int32)), pa.array(pieces, pa.binary())],
                    names=["anchor", "c1", "c2", "copies", "windows", "body"],
                )

    return run


class Segment(NamedTuple):
    anchor: int
    c1: int
    c2: int
    copies: int
    windows: int
    body: bytes


def by_anchor(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[Segment]]:
    """Whole anchor groups of sorted rows, several together up to about ``limit`` bytes of segments.

    A segment met again (a repeated row of the input) is skipped; its copies are counted already.
    """
    held: list[Segment] = []
    size = 0
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        for row in map(Segment._make, zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            if held and row[:3] == held[-1][:3]:
                continue
            if size >= limit and row.anchor != held[-1].anchor:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row.body)
    if held:
        yield held


#: Unit ranges of a segment that recur, and the group of equal ranges that each belongs to (0 where groups are merged).
SPANS = "c1 long, c2 long, spans array<struct<a:long,b:long,g:long>>"


def span_rows(rows: list[tuple]) -> pa.RecordBatch:
    """rows: (c1, c2, [(from, to, group), ...])"""
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("g", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([[{"a": a, "b": b, "g": g} for a, b, g in r[2]] for r in rows], kind)],
        names=["c1", "c2", "spans"],
    )


def flagged_runs(flags: np.ndarray) -> np.ndarray:
    """[[from, to), ...] of the runs of true values."""
    change = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return change.reshape(-1, 2)


def covered(length: int, spans: np.ndarray) -> np.ndarray:
    """Which of ``length`` units lie in one of the spans (an (n, 2) array)."""
    step = np.zeros(length + 1, dtype=np.int64)
    np.add.at(step, spans[:, 0], 1)
    np.add.at(step, spans[:, 1], -1)
    return np.cumsum(step[:-1]) > 0


def located(texts: DataFrame, units: Units, cut, confirm, level: int = 0) -> DataFrame:
    """(r1, r2, s): each unit range s (a, b, g) of each text that recurs.

    texts: r1, r2, copies, text; confirm: sorted rows of ``bodies``, by partition, -> SPANS, the exact step.
    """
    found = materialize(occurrences(texts, units, units.grams[level]))
    picked = materialize(recurring(found))
    cold = picked if level == len(units.grams) - 1 else picked.where("not hot")
    dealt = bodies(texts, cold, cut).repartition(F.col("anchor")).sortWithinPartitions("anchor", "c1", "c2")
    spans = dealt.mapInArrow(confirm, SPANS)
    if level < len(units.grams) - 1 and not (hot := picked.where("hot")).isEmpty():
        again = bodies(texts, hot, cut).select(F.col("c1").alias("r1"), F.col("c2").alias("r2"), "copies", F.col("body").alias("text"))
        inner = located(materialize(again.dropDuplicates(["r1", "r2"])), units, cut, confirm, level + 1)
        spans = spans.union(inner.groupBy(F.col("r1").alias("c1"), F.col("r2").alias("c2")).agg(F.collect_set("s").alias("spans")))
    weighed = materialize(spans.join(picked.select("c1", "c2", "copies"), ["c1", "c2"]))
    # a segment in a third of all rows is one key here
    places = skew_join(found.select("c1", "c2", "r1", "r2", "first"), weighed, ["c1", "c2"], "copies", ["r1", "r2", "first"])
    places = places.select("r1", "r2", "first", F.explode("spans").alias("s"))
    return places.select("r1", "r2", F.struct((F.col("first") + F.col("s.a")).alias("a"), (F.col("first") + F.col("s.b")).alias("b"), F.col("s.g").alias("g")).alias("s"))


def with_spans(docs: DataFrame, units: Units, cut, confirm) -> DataFrame:
    """doc_id, text and _spans, the unit ranges of each row's text that recur."""
    docs = keyed(docs)
    spans = located(docs.withColumn("copies", F.lit(1).cast("long")), units, cut, confirm)
    return docs.join(spans.groupBy("r1", "r2").agg(F.collect_set("s").alias("_spans")), ["r1", "r2"], "left").select("doc_id", "text", "_spans")


def spans_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and the flat (n, 2) spans of a _spans column; null counts as none."""
    sizes = np.array([0 if v is None else v for v in pa.compute.list_value_length(column).to_pylist()], dtype=np.int64)
    flat = column.flatten()
    pairs = np.stack([flat.field("a").to_numpy(zero_copy_only=False), flat.field("b").to_numpy(zero_copy_only=False)], axis=1) if len(flat) else np.zeros((0, 2), np.int64)
    return np.concatenate(([0], np.cumsum(sizes))), pairs.astype(np.int64)
