"""Substring dedup: recurring passages, located by sharded Aho-Corasick automata.

Segments of text (see ``repeats``) are dealt by anchor; a block of whole anchor
groups is a shard, and every segment of every document that could hold one of
the shard's passages is in it. Windows of ``window`` words that may recur are
told by counting their hashes, and of each only one witness is kept: runs of
witnesses are the shard's passages. Their windows are compiled into one automaton
over word numbers, and all segments are streamed through it. A window is
confirmed, word for word, by the automaton's matches in two places at least;
what is removed comes from these matches alone.

Nulls and texts of white space hold no words. A row that occurs twice repeats
itself, and rows without a doc_id are separate texts. Windows never cross
documents. Ties don't arise. An empty table gives no rows. Other columns of the
input, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import hashing as H
from . import repeats as R

#: Bytes of segments in one shard: some 20,000 windows at most, so under a million nodes of an automaton.
SHARD = 1 << 17


def word_units(window: int) -> R.Units:
    return R.Units(window, R.gram_lengths(window, max(1, min(12, window // 2))), lambda raw: H.word_hashes(raw, np.array([0, len(raw)]))[1])


def _piece(window: int):
    def cut(raw: np.ndarray, first: np.ndarray, windows: np.ndarray) -> list[bytes]:
        at = H.word_hashes(raw, np.array([0, len(raw)]))[0]
        at = np.append(at, len(raw))
        stop = np.minimum(first + windows + window - 1, len(at) - 1)
        return [raw[a:b].tobytes() for a, b in zip(at[first].tolist(), at[stop].tolist(), strict=True)]

    return cut


def passages(texts: list[tuple[int, ...]], copies: list[int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """The patterns of a shard: runs of one witness each of the windows that may start in two places, and their pattern length.

    A run that no other text holds any window of (its text was found several
    times) is one pattern; of other runs each window is one.
    """
    size = np.array([len(t) for t in texts], dtype=np.int64)
    base = np.concatenate(([0], np.cumsum(size)))
    flat = np.fromiter((w for t in texts for w in t), dtype=np.int64, count=int(base[-1]))
    windows = np.maximum(size - window + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + base[owner]
    total = H.running(H.mix(flat.astype(np.uint64) + np.uint64(1)))
    _, first, which, held = np.unique(H.range_hashes(total, start, start + window), return_index=True, return_inverse=True, return_counts=True)
    several = np.bincount(which, weights=np.array(copies, dtype=np.float64)[owner]) > 1
    # a run ends where its text does and where windows begin or cease to be held elsewhere too
    witness = np.full(len(flat) + 1, -1, dtype=np.int64)
    witness[start[first[several]]] = 2 * owner[first[several]] + (held[several] > 1)
    edges = np.flatnonzero(np.diff(witness, prepend=-1))
    out: list[tuple[tuple[int, ...], int]] = []
    if not len(edges):  # no window of the shard starts in two places
        return out
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(witness)], strict=True):
        if (kind := int(witness[a])) >= 0:
            run = tuple(flat[a : b + window - 1].tolist())
            out.append((run, window if kind % 2 else len(run)))
    return out


def automaton(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[ahocorasick.Automaton, np.ndarray]:
    """All patterns of the runs, each with a number of its own, and their lengths."""
    out = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    lengths: list[int] = []
    for run, length in patterns:
        for i in range(len(run) - length + 1):
            out.add_word(run[i : i + length], len(lengths))
            lengths.append(length)
    out.make_automaton()
    return out, np.array(lengths, dtype=np.int64)


def matches(texts: list[tuple[int, ...]], copies: list[int], window: int) -> list[list[tuple[int, int]]]:
    """(from, to) of the words of each text that lie in a pattern which the automaton finds in two places at least."""
    if not (patterns := passages(texts, copies, window)):
        return [[] for _ in texts]
    machine, lengths = automaton(patterns)
    places = np.zeros(len(lengths), dtype=np.int64)
    found = []
    for text, n in zip(texts, copies, strict=True):
        own = np.array(list(machine.iter(text)), dtype=np.int64).reshape(-1, 2)
        found.append(own)
        np.add.at(places, own[:, 1], n)
    out = []
    for text, own in zip(texts, found, strict=True):
        own = own[places[own[:, 1]] > 1]
        ends = own[:, 0] + 1
        spans = np.stack([ends - lengths[own[:, 1]], ends], axis=1)
        out.append([(a, b) for a, b in R.flagged_runs(R.covered(len(text), spans)).tolist()])
    return out


def _confirm(window: int):
    def shard(rows: list[R.Segment]) -> list[tuple]:
        numbers: dict[bytes, int] = {}
        texts = [tuple([numbers.setdefault(w, len(numbers)) for w in r.body.split()]) for r in rows]
        spans = matches(texts, [r.copies for r in rows], window)
        return [(r.c1, r.c2, [(a, b, 0) for a, b in own]) for r, own in zip(rows, spans, strict=True) if own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in R.by_anchor(batches, SHARD):
            if out := shard(rows):
                yield R.span_rows(out)

    return run


_OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digest(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = H.text_buffers(batch.column("text"))
            edges, spans = R.spans_of(batch.column("_spans"))
            rows: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else []))}
            for i in range(batch.num_rows):
                words = raw[at[i] : at[i + 1]].tobytes().split()
                flags = R.covered(len(words), spans[edges[i] : edges[i + 1]])
                if flags.any():
                    words_kept = [w for w, gone in zip(words, flags.tolist(), strict=True) if not gone]
                else:
                    words_kept = words
                kept = b" ".join(words_kept)
                rows["n_words"].append(len(words))
                rows["n_removed"].append(len(words) - len(words_kept))
                rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    rows["kept"].append(kept.decode("utf-8"))
            kinds = {"kept_sha256": pa.string(), "kept": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items())], names=["doc_id", *rows])

    return run


def phrase_dedup(docs: DataFrame, window: int = 35, keep_text: bool = False) -> DataFrame:
    """Remove every word inside ``window`` consecutive words that also start elsewhere.

    One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept
    words joined by one space) and, with keep_text, kept.
    """
    joined = R.with_spans(docs, word_units(window), R.cutter(_piece(window)), _confirm(window))
    return joined.mapInArrow(_digest(keep_text), _OUT + (", kept string" if keep_text else ""))
