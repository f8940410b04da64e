"""Suffix-array dedup: maximal repeats from the common-prefix interval tree of an enhanced suffix array.

The candidate suffixes (those whose first ``min_bytes`` bytes may occur twice)
are dealt by anchor, so every occurrence of a long repeat meets in one block of
bounded size. In a block they are sorted into a suffix array with the lengths of
common prefixes; a scan with a stack visits the intervals of suffixes that share
at least ``min_bytes`` bytes; an interval is a maximal repeat if its occurrences
are preceded by different bytes. All occurrences of the group are marked, not
just neighbours in the array.

A segment is shorter than two windows; a group is maximal within its segments
(``repeat_groups`` returns the groups with all occurrences), and the segments of a
longer repeat overlap, so that together they mark all of it.

Nulls and empty texts hold no bytes. A row that occurs twice repeats itself, and
rows without a doc_id are separate texts. Text of any length is handled in slices;
ties don't arise, as a span is removed wherever it occurs. An empty table gives no
rows. Other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from . import repeats as R

#: Bytes of segments in one block of suffixes.
BLOCK = 1 << 19
#: Suffixes that are sorted at a time.
SUFFIXES = 40_000


def byte_units(min_bytes: int) -> R.Units:
    return R.Units(min_bytes, R.gram_lengths(min_bytes, max(1, min(64, min_bytes // 4))), lambda raw: H.BYTE_HASH[raw])


def _piece(min_bytes: int):
    def cut(raw: np.ndarray, first: np.ndarray, windows: np.ndarray) -> list[bytes]:
        return [raw[a : a + n + min_bytes - 1].tobytes() for a, n in zip(first.tolist(), windows.tolist(), strict=True)]

    return cut


def maximal_repeats(text: bytes, total: np.ndarray, starts: np.ndarray, begins: np.ndarray, ends: np.ndarray, min_len: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, occurrences) of the maximal repeats among candidate suffixes.

    starts: positions in ``text`` where candidates start; begins, ends: where
    the segment begins and ends that each stands in; total: running hashes.
    """
    if len(starts) < 2:
        return
    keys = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
    del keys
    place, begin, stop = starts[order], begins[order], ends[order]
    room = np.minimum(stop[:-1] - place[:-1], stop[1:] - place[1:])
    lcp = _exact(text, place[:-1], place[1:], common_prefix(total, place[:-1], place[1:], room, min_len))
    # the byte before a suffix; where its segment begins, a mark of its own
    raw = np.frombuffer(text, dtype=np.uint8)
    before = np.where(place > begin, raw[np.maximum(place - 1, 0)].astype(np.int64), -1 - np.arange(len(place)))
    groups = R.flagged_runs(lcp >= min_len)
    sizes = groups[:, 1] - groups[:, 0]
    for lo in groups[sizes == 1][:, 0].tolist():  # two suffixes: an interval without a tree
        if before[lo] != before[lo + 1]:
            yield int(lcp[lo]), place[lo : lo + 2]
    for lo, hi in groups[sizes > 1].tolist():
        yield from _intervals(lcp, before, place, lo, hi)


def _intervals(lcp: np.ndarray, before: np.ndarray, place: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray]]:
    """Scan one run of the array (suffixes lo..hi) for left-diverse common-prefix intervals.

    A stack entry is [length, first suffix, preceding byte]; the byte is None
    once the interval's suffixes are known to be preceded by different ones.
    """
    stack: list[list] = []
    marks = before[lo : hi + 1].tolist()
    lengths = [*lcp[lo:hi].tolist(), -1]
    for i, length in enumerate(lengths):
        left, mark = i, marks[i]
        while stack and stack[-1][0] > length:
            top, left, own = stack.pop()
            mark = own if own == mark else None
            if mark is None:
                yield top, place[lo + left : lo + i + 1]
            if stack and stack[-1][0] == length:
                break
        if length < 0:
            return
        if stack and stack[-1][0] == length:
            if stack[-1][2] != mark:
                stack[-1][2] = None
        else:
            stack.append([length, left, mark])


def common_prefix(total: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, least: int) -> np.ndarray:
    """Length of the common prefix at positions a and b, at most ``room``; 0 where it is under ``least``."""
    out = np.zeros(len(a), dtype=np.int64)
    same = lambda i, j, n: H.range_hashes(total, i, i + n) == H.range_hashes(total, j, j + n)
    long = np.flatnonzero(room >= least)
    long = long[same(a[long], b[long], least)]
    x, y, lo, hi = a[long], b[long], np.full(len(long), least, np.int64), room[long].astype(np.int64)
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        ok = same(x, y, mid)
        lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
    out[long] = lo
    return out


def _exact(text: bytes, a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """``lcp`` with 0 where the bytes themselves differ, which equal hashes don't rule out."""
    for i in np.flatnonzero(lcp).tolist():
        x, y, n = int(a[i]), int(b[i]), int(lcp[i])
        if text[x : x + n] != text[y : y + n]:
            lcp[i] = 0
    return lcp


def _parts(hashes: np.ndarray) -> Iterator[slice]:
    """Slices of about SUFFIXES sorted hashes that don't part equal ones."""
    at = 0
    while at < len(hashes):
        to = min(at + SUFFIXES, len(hashes))
        to = int(np.searchsorted(hashes, hashes[to - 1], side="right"))
        yield slice(at, to)
        at = to


def _repeats(rows: list[R.Segment], min_bytes: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, occurrences) of the repeat groups of a block; occurrences are places in its joined segments."""
    text = b"".join(r.body for r in rows)
    base = np.concatenate(([0], np.cumsum([len(r.body) for r in rows])))
    windows, copies = np.array([r.windows for r in rows]), np.array([r.copies for r in rows])
    owner = np.repeat(np.arange(len(rows)), windows)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + base[owner]
    total = H.running(H.BYTE_HASH[np.frombuffer(text, dtype=np.uint8)])
    # suffixes whose first bytes are those of no other suffix are no repeat
    order = np.argsort(hashes := H.range_hashes(total, start, start + min_bytes))
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(start), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    chosen = order[twice[order]]
    for some in _parts(hashes[chosen]):  # suffixes with the same first bytes stay together
        at = chosen[some]
        yield from maximal_repeats(text, total, start[at], base[owner[at]], base[1:][owner[at]], min_bytes)
    # a segment that was found several times is one leaf with all its copies: a repeat as long as itself
    for i in np.flatnonzero(copies > 1).tolist():
        yield int(base[i + 1] - base[i]), base[i : i + 1]


def _confirm(min_bytes: int, groups: bool = False):
    def merged(rows: list[R.Segment]) -> list[tuple]:
        base = np.concatenate(([0], np.cumsum([len(r.body) for r in rows])))
        step = np.zeros(base[-1] + 1, dtype=np.int64)
        for length, where in _repeats(rows, min_bytes):
            np.add.at(step, where, 1)
            np.add.at(step, where + length, -1)
        flags = np.cumsum(step[:-1]) > 0
        runs = ((r, R.flagged_runs(flags[a:b])) for r, a, b in zip(rows, base[:-1], base[1:], strict=True))
        return [(r.c1, r.c2, [(a, b, 0) for a, b in spans.tolist()]) for r, spans in runs if len(spans)]

    def grouped(rows: list[R.Segment]) -> list[tuple]:
        text = b"".join(r.body for r in rows)
        base = np.concatenate(([0], np.cumsum([len(r.body) for r in rows])))
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for length, where in _repeats(rows, min_bytes):
            at = int(where[0])
            name = int.from_bytes(hashlib.blake2b(text[at : at + length], digest_size=8).digest(), "little", signed=True)
            owner = np.searchsorted(base, where, side="right") - 1
            for i, off in zip(owner.tolist(), (where - base[owner]).tolist(), strict=True):
                spans.setdefault(i, []).append((off, off + length, name))
        return [(rows[i].c1, rows[i].c2, own) for i, own in spans.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in R.by_anchor(batches, BLOCK):
            if out := (grouped if groups else merged)(rows):
                yield R.span_rows(out)

    return run


def repeat_groups(docs: DataFrame, min_bytes: int = 400) -> DataFrame:
    """(group, length, doc_id, start): every occurrence, in bytes from 0, of every maximal repeat group.

    A repeat longer than a segment (less than two windows) shows as overlapping
    groups, one for each segment; together they cover the same bytes.
    """
    keyed = R.keyed(docs)
    found = R.located(keyed.withColumn("copies", F.lit(1).cast("long")), byte_units(min_bytes), R.cutter(_piece(min_bytes)), _confirm(min_bytes, groups=True))
    rows = keyed.select("r1", "r2", "doc_id").join(found.distinct(), ["r1", "r2"])
    return rows.select(F.col("s.g").alias("group"), (F.col("s.b") - F.col("s.a")).alias("length"), "doc_id", F.col("s.a").alias("start"))


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = H.text_buffers(batch.column("text"))
            edges, spans = R.spans_of(batch.column("_spans"))
            rows: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else []))}
            for i in range(batch.num_rows):
                own = raw[at[i] : at[i + 1]]
                flags = R.covered(len(own), spans[edges[i] : edges[i + 1]])
                kept = own[~flags].tobytes()
                rows["n_bytes"].append(len(own))
                rows["n_removed"].append(int(flags.sum()))
                rows["n_spans"].append(len(R.flagged_runs(flags)))
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    rows["kept"].append(kept)
            kinds = {"kept_sha256": pa.string(), "kept": pa.binary()}
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items())], names=["doc_id", *rows])

    return run


def suffix_dedup(docs: DataFrame, min_bytes: int = 400, keep_text: bool = False) -> DataFrame:
    """Remove every byte inside a string of ``min_bytes`` bytes that also starts elsewhere.

    One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and,
    with keep_text, kept (the remaining bytes; they may no longer be UTF-8).
    """
    joined = R.with_spans(docs, byte_units(min_bytes), R.cutter(_piece(min_bytes)), _confirm(min_bytes))
    return joined.mapInArrow(_digest(keep_text), _OUT + (", kept binary" if keep_text else ""))
