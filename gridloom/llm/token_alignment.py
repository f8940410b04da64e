"""Alignment of two tokenizers' tokens, with corpus-wide counts of the id pairs that overlap.

Each text is encoded twice, by a byte-level BPE (A) and a SentencePiece BPE (B), and
both are laid over the text's bytes. Places where tokens of both end cut them into
groups; an A and a B token whose bytes overlap are a link.

Counting is external. A task cuts its links into runs: records (B id, A id,
document) sorted in B-major order, radix-partitioned by the low bits of the B id and
compressed with zstd. The runs are written as a table. A k-way heap merge adds up
the pairs of at most ``FAN_IN`` runs of one radix, Spark adds the sums of the
merges, and B-major order yields the highest count of each B id as the counts are
packed. The packed counts then stream past the runs again, and what each record adds
to its document goes back by the document's row.

Nothing grows in one task: a run has a bounded number of links (or some documents'), a
merge a bounded number of runs, a block of counts at most 64 B ids. A pair that
stands in every document is one entry of each run and is added up before it is
shuffled. The two vocabularies are broadcast; their files' sizes don't depend on the input.

A text has no tokens, and zeros in all columns, if it is null or empty, or if the
tokens' bytes, joined, aren't a space and the text (a literal U+2581, for one).
Rows that share a doc_id, or have none, are rows of their own and all count. Ties for
a B id's highest count are all best. Very long texts are worked on whole, word by word;
a word is encoded once and its tokens remembered, as no token reaches over a word's start. An empty
table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sentence_pieces import MODEL, SPACE, Pieces, slices
from .tables import materialize, ship

BYTES_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: how byte-level BPE of this kind splits a text before it merges bytes.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs: links a run holds before it is closed, and radixes that the B ids are dealt to by their low bits.
RUN_LINKS, RADIX_BITS = 1 << 21, 5
#: A run numbers its documents in 16 bits.
DOC_BITS = 16
FAN_IN = 64
#: B ids of one radix in a block of counts.
BLOCK_IDS = 64
#: Words whose tokens are remembered in a task.
WORDS = 1 << 18
#: Where a space stands between two other characters, both kinds of tokens begin anew.
WORD_STARTS = re.compile(r"(?<=\S)(?= \S)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """The byte-level vocabulary of a tokenizer file, with the encoder that works on ranks."""

    def __init__(self, spec: bytes) -> None:
        told = json.loads(spec)
        model, split, letters = told["model"], told["pre_tokenizer"], byte_letters()
        if model["type"] != "BPE" or told["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or model["dropout"]:
            raise ValueError("a byte-level BPE without normalizer and prefix is needed")
        special = {t["content"] for t in told["added_tokens"]}
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in special}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("ids must rise in the order of merges, as ranks do")
        self.encode = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={})
        self.lengths = np.zeros(max(self.bytes) + 1, np.int64)
        for i, b in self.bytes.items():
            self.lengths[i] = len(b)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.encode.encode_ordinary(text), np.int64)


class PieceTokens:
    """The pieces of a SentencePiece model."""

    def __init__(self, model: bytes) -> None:
        self.pieces = Pieces(model)
        whole = self.pieces.whole
        part = lambda i: bytes([int(whole.id_to_piece(i)[3:-1], 16)]) if whole.is_byte(i) else whole.id_to_piece(i).replace(SPACE, " ").encode()
        self.bytes = [part(i) for i in range(whole.get_piece_size())]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text that begins with the space which the model adds."""
        return np.array(self.pieces.part.encode(text.replace(" ", SPACE)), np.int64)


class Aligned(NamedTuple):
    a: np.ndarray  # ids
    b: np.ndarray
    to_a: np.ndarray  # the byte at which each token ends
    to_b: np.ndarray
    ends_a: np.ndarray  # is the token the last of its group?
    ends_b: np.ndarray
    left: np.ndarray  # links: places of the A and the B token
    right: np.ndarray


def overlay(a: np.ndarray, b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray) -> Aligned:
    """Tokens of the same bytes: groups, and links, one for each byte place where a token of either kind starts."""
    to_a, to_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    over_a, over_b = np.searchsorted(to_b, to_a), np.searchsorted(to_a, to_b)  # the other token that holds each token's last byte
    ends_a, ends_b = to_b[over_a] == to_a, to_a[over_b] == to_b
    first_b = np.concatenate(([0], (over_a + ends_a)[:-1]))  # the B token at each A token's first byte
    inside = np.flatnonzero(~ends_b[:-1]) + 1  # B tokens that start within an A token
    return Aligned(a, b, to_a, to_b, ends_a, ends_b, np.concatenate((np.arange(len(a)), over_b[inside - 1])), np.concatenate((first_b, inside)))


class Labels:
    """Decimal ids with the sign that follows them, as rows of bytes padded with zeros."""

    def __init__(self, size: int) -> None:
        digits = len(str(size))
        self.of = {sign: np.array([f"{i}{sign}".encode() for i in range(size)], f"S{digits + 1}") for sign in ",|;\n"}

    def text(self, x: Aligned, last: np.ndarray) -> bytes:
        """a1,a2|b1;a3|b2,b3 with a line's end after the B tokens at the places ``last``."""
        group_a, group_b = np.cumsum(x.ends_a) - x.ends_a, np.cumsum(x.ends_b) - x.ends_b
        before_b, with_a = np.concatenate(([0], np.flatnonzero(x.ends_b) + 1)), np.flatnonzero(x.ends_a) + 1
        b = np.where(x.ends_b, self.of[";"][x.b], self.of[","][x.b])
        b[last] = self.of["\n"][x.b[last]]
        out = np.empty(len(x.a) + len(x.b), b.dtype)
        out[np.arange(len(x.a)) + before_b[group_a]] = np.where(x.ends_a, self.of["|"][x.a], self.of[","][x.a])
        out[np.arange(len(x.b)) + with_a[group_b]] = b
        return out.tobytes().translate(None, b"\0")


class Layout(NamedTuple):
    """Where a record keeps its radix, the rest of the B id, the A id and the document, from high to low bits."""

    rest_bits: int
    a_bits: int

    @classmethod
    def of(cls, size_a: int, size_b: int) -> Layout:
        out = cls(max(0, int(size_b - 1).bit_length() - RADIX_BITS), int(size_a - 1).bit_length())
        if RADIX_BITS + out.rest_bits + out.a_bits + DOC_BITS > 63:
            raise ValueError("vocabularies are too large for records of 63 bits")
        return out

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        radix = (b & ((1 << RADIX_BITS) - 1)) << self.rest_bits
        return ((radix | b >> RADIX_BITS) << self.a_bits) | a

    def ids(self, radix: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A and B ids of the keys of one radix."""
        return key & ((1 << self.a_bits) - 1), (key >> self.a_bits) << RADIX_BITS | radix


def pack(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    """Columns of one length, written by ``pack``."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


PAIRS, RECORDS, COUNTS = ("<i8", "<i4", "<i8"), ("<u2", "<i4"), ("<i8", "<i8", "?")


def runs_of(records: np.ndarray, layout: Layout) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, records) of one run: pairs are (key, documents, links), records (document, links) in the pairs' order."""
    records = np.sort(records)
    first = np.flatnonzero(np.concatenate(([True], records[1:] != records[:-1])))
    links, records = np.diff(np.append(first, len(records))), records[first]
    pair = records >> DOC_BITS
    begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    keys, held, sums = pair[begin], np.diff(np.append(begin, len(pair))), np.add.reduceat(links, begin)
    within = layout.rest_bits + layout.a_bits
    edges = np.searchsorted(keys >> within, np.arange((1 << RADIX_BITS) + 1))
    places = np.append(begin, len(pair))
    for radix, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if i < j:
            x, y = places[i], places[j]
            key = keys[i:j] & ((1 << within) - 1)
            yield (
                radix,
                pack(np.diff(key, prepend=0).astype("<i8"), held[i:j].astype("<i4"), sums[i:j].astype("<i8")),
                pack((records[x:y] & ((1 << DOC_BITS) - 1)).astype("<u2"), links[x:y].astype("<i4")),
            )


BASE = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary"
RUN = "run long, radix int, first_row long, pairs binary, records binary"


class WordTable:
    """Tokens, groups and links of words, each encoded and overlaid once in a task.

    Neither kind of token reaches over a word's start, so a text's tokens, groups and
    links are those of its words, one after another. New words are encoded together,
    as one text, unless white space at their edges or a literal U+2581 could join them.
    Word 0 stands for words whose tokens don't give their bytes back.
    """

    def __init__(self, a: ByteTokens, b: PieceTokens, layout: Layout) -> None:
        self.a, self.b, self.layout = a, b, layout
        self.labels = Labels(max(len(a.lengths), len(b.lengths)))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.texts = [""]
        self.sizes = np.zeros((1, 4), np.int64)  # A tokens, B tokens, groups, links
        self.links = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)

    def lay(self, text: str) -> Aligned | None:
        a, b, raw = self.a.ids(text), self.b.ids(text), text.encode()
        same = b"".join([self.a.bytes[i] for i in a.tolist()]) == raw == b"".join([self.b.bytes[i] for i in b.tolist()])
        return overlay(a, b, self.a.lengths, self.b.lengths) if same else None

    def add(self, words: list[str]) -> None:
        plain = [w for w in words if not (w[1:2].isspace() or w[-1].isspace() or SPACE in w)]
        whole = self.lay("".join(plain)) if plain else None
        made = [(plain, whole)] if whole else []
        done = set(plain) if whole else set()
        made += [([w], self.lay(w)) for w in words if w not in done]
        sizes, links = [self.sizes], [self.links]
        for some, x in made:
            if x is None:
                self.known[some[0]] = 0
                continue
            self.known |= zip(some, range(len(self.texts), len(self.texts) + len(some)), strict=True)
            ends = np.cumsum([len(w.encode()) for w in some])
            last_a, last_b = np.searchsorted(x.to_a, ends), np.searchsorted(x.to_b, ends)
            n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
            of = np.repeat(np.arange(len(some)), n_a)
            sizes.append(np.stack((n_a, n_b, np.bincount(of[x.ends_a], minlength=len(some)), np.bincount(of[x.left], minlength=len(some))), axis=1))
            links.append(self.layout.pair(x.a[x.left], x.b[x.right])[np.argsort(of[x.left], kind="stable")])
            self.texts += self.labels.text(x, last_b).decode().splitlines()
        self.sizes, self.links = np.concatenate(sizes), np.concatenate(links)
        self.begin = np.concatenate(([0], np.cumsum(self.sizes[:, 3])))

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' words, those of a text with a word 0 being all 0, and how many words each has."""
        split = [WORD_STARTS.split(" " + t) if t else [] for t in texts]
        distinct = dict.fromkeys(w for words in split for w in words)
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > WORDS:
            self.clear()
            new = list(distinct)
        if new:
            self.add(new)
        counts = np.array([len(words) for words in split], np.int64)
        found = np.fromiter((self.known[w] for words in split for w in words), np.int64, int(counts.sum()))
        doc = np.repeat(np.arange(len(texts)), counts)
        bad = np.zeros(len(texts), bool)
        bad[doc[found == 0]] = True
        found[bad[doc]] = 0
        return found, counts

    def pairs(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All links' pairs of a list of words, and the place in that list of each one's word."""
        n = self.sizes[found, 3]
        word = np.repeat(np.arange(len(found)), n)
        return self.links[np.arange(len(word)) + (self.begin[found] - (np.cumsum(n) - n))[word]], word


@lru_cache(1)
def word_table(spec: bytes, model: bytes) -> WordTable:
    """One a Python worker: the next task goes on with the words that are known."""
    a, b = ByteTokens(spec), PieceTokens(model)
    return WordTable(a, b, Layout.of(len(a.lengths), len(b.lengths)))


def _align(shared, layout: Layout, want_groups: bool, run_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(*shared.value)
        row = run_no = first = TaskContext.get().partitionId() << 36
        waiting: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            found = list(runs_of(np.concatenate(waiting), layout)) if size else []
            n = len(found)
            columns = [pa.nulls(n, k) for k in [pa.int64()] * 6 + [pa.binary()]]
            columns += [pa.array([run_no] * n, pa.int64()), pa.array([f[0] for f in found], pa.int32()), pa.array([first] * n, pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([f[i] for f in found], pa.binary()) for i in (1, 2))], names=NAMES)

        for batch in slices(batches):
            n = batch.num_rows
            if size >= run_links or row + n - first > 1 << DOC_BITS:
                yield close()
                waiting, size, first, run_no = [], 0, row, run_no + 1
            found, counts = table.of(batch.column("text").to_pylist())
            pairs, word = table.pairs(found)
            doc = np.repeat(np.arange(n), counts)
            waiting.append(pairs << DOC_BITS | (row - first + doc)[word])
            size += len(pairs)
            to = np.concatenate(([0], np.cumsum(counts)))
            sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(table.sizes[found], axis=0)))
            sums = sums[to[1:]] - sums[to[:-1]]
            groups = [";".join([table.texts[i] for i in found[s:e].tolist()]) if want_groups and x else "" for s, e, x in zip(to[:-1], to[1:], sums[:, 0], strict=True)]
            arrays = [pa.array(np.arange(row, row + n)), batch.column("doc_id"), *(pa.array(np.ascontiguousarray(c)) for c in sums.T), pa.array([g.encode() for g in groups], pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.nulls(n, k) for k in (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=NAMES)
            row += n
        yield close()

    return run


NAMES = [c.split()[0] for c in f"{BASE}, {RUN}".split(", ")]


def _merge(layout: Layout):
    """K-way heap merge of at most a few FAN_IN runs of one radix: the sum of each pair's links."""

    def run(table: pa.Table) -> pa.Table:
        radix = table.column("radix")[0].as_py()

        def entries(data: bytes) -> Iterator[tuple[int, int]]:
            step, _, links = unpack(data, *PAIRS)
            return zip(np.cumsum(step).tolist(), links.tolist(), strict=True)

        keys, sums = [], []
        for key, same in groupby(heapq.merge(*(entries(x.as_py()) for x in table.column("pairs"))), key=itemgetter(0)):
            keys.append(key)
            sums.append(sum(n for _, n in same))
        a, b = layout.ids(radix, np.array(keys, np.int64))
        return pa.table({"a_id": pa.array(a, pa.int64()), "b_id": pa.array(b, pa.int64()), "count": pa.array(sums, pa.int64())})

    return run


def _pack(layout: Layout):
    """One block of counts in B-major order, each with whether it is the highest of its B id."""

    def run(table: pa.Table) -> pa.Table:
        a, b, count = (table.column(c).to_numpy() for c in ("a_id", "b_id", "count"))
        order = np.lexsort((a, b))
        a, b, count = a[order], b[order], count[order]
        begin = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
        best = np.repeat(np.maximum.reduceat(count, begin), np.diff(np.append(begin, len(b)))) == count
        key = (b >> RADIX_BITS) << layout.a_bits | a
        return pa.table({"radix": table.column("radix")[:1], "block": table.column("block")[:1], "counts": pa.array([pack(np.diff(key, prepend=0).astype("<i8"), count.astype("<i8"), best)], pa.binary())})

    return run


def _give_back(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """Streams the blocks of counts, in order, past the runs: what each document gains."""
    held = []
    for first, pairs, records in zip(*(runs.column(c).to_pylist() for c in ("first_row", "pairs", "records")), strict=True):
        step, n_docs, _ = unpack(pairs, *PAIRS)
        docs, links = unpack(records, *RECORDS)
        top = int(docs.max()) + 1
        held.append((first, np.cumsum(step), np.concatenate(([0], np.cumsum(n_docs))), docs.astype(np.int64), links.astype(np.int64), np.zeros(top, np.int64), np.zeros(top, np.int64)))
    for _, data in sorted(zip(counts.column("block").to_pylist(), counts.column("counts").to_pylist(), strict=True)):
        step, count, best = unpack(data, *COUNTS)
        key = np.cumsum(step)
        for _, keys, places, docs, links, n_best, total in held:
            i, j = np.searchsorted(keys, key[0]), np.searchsorted(keys, key[-1], "right")
            if i == j:
                continue
            at = np.repeat(np.searchsorted(key, keys[i:j]), np.diff(places[i : j + 1]))
            own = slice(places[i], places[j])
            np.add.at(total, docs[own], count[at] * links[own])
            np.add.at(n_best, docs[own], best[at] * links[own])
    rows, gains = [], []
    for first, _, _, _, _, n_best, total in held:
        some = np.flatnonzero(total)
        rows.append(first + some)
        gains.append((n_best[some], total[some]))
    return pa.table({"row": pa.array(np.concatenate(rows), pa.int64()), "n_best": pa.array(np.concatenate([g[0] for g in gains]), pa.int64()), "count_sum": pa.array(np.concatenate([g[1] for g in gains]), pa.int64())})


class Corpus(NamedTuple):
    """The written table of documents and runs, with the records' layout."""

    table: DataFrame
    layout: Layout
    salts: int

    def runs(self) -> DataFrame:
        return self.table.where("run is not null").select(F.pmod(F.xxhash64("run"), F.lit(self.salts)).cast("int").alias("salt"), "radix", "first_row", "pairs", "records")


def spill(docs: DataFrame, a: str = BYTES_MODEL, b: str = MODEL, groups: str | None = "text") -> Corpus:
    """Encodes and overlays all texts, and writes documents and runs.

    groups: the groups' "text", its "sha256", or None.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(a, "rb") as f, open(b, "rb") as g:  # the driver's copies go to all tasks: a few megabytes, whatever the input
        files = f.read(), g.read()
    layout = word_table(*files).layout
    shared = spark.sparkContext.broadcast(files)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = given.mapInArrow(_align(shared, layout, groups is not None, RUN_LINKS), f"{BASE}, {RUN}")
    if groups == "sha256":
        made = made.withColumn("groups", F.when(F.col("row").isNotNull(), F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")))
    else:
        made = made.withColumn("groups", F.col("groups").cast("string"))
    table = materialize(made)
    n = table.where("run is not null").select(F.countDistinct("run")).first()[0]
    return Corpus(table, layout, max(1, -(-n // FAN_IN)))


def pair_counts(corpus: Corpus) -> DataFrame:
    """(a_id, b_id, count): how many links hold the two ids linked, over all documents."""
    merged = corpus.runs().select("salt", "radix", "pairs").groupBy("radix", "salt").applyInArrow(_merge(corpus.layout), "a_id long, b_id long, count long")
    return merged.groupBy("a_id", "b_id").agg(F.sum("count").alias("count"))


def contributions(corpus: Corpus, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum): the links of each document's row that are best, and the sum of their counts."""
    low = F.lit((1 << RADIX_BITS) - 1)
    placed = counts.select("*", F.col("b_id").bitwiseAND(low).cast("int").alias("radix"), F.floor(F.col("b_id") / ((1 << RADIX_BITS) * BLOCK_IDS)).cast("int").alias("block"))
    blocks = materialize(placed.groupBy("radix", "block").applyInArrow(_pack(corpus.layout), "radix int, block int, counts binary"))
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(corpus.salts - 1))))
    both = corpus.runs().groupBy("radix", "salt").cogroup(blocks.groupBy("radix", "salt")).applyInArrow(lambda x, y: _give_back(x, y) if x.num_rows else _NOTHING, "row long, n_best long, count_sum long")
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


_NOTHING = pa.table({c: pa.array([], pa.int64()) for c in ("row", "n_best", "count_sum")})


def align(docs: DataFrame, a: str = BYTES_MODEL, b: str = MODEL, groups: str | None = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (see ``spill``)."""
    corpus = spill(docs, a, b, groups)
    gained = contributions(corpus, pair_counts(corpus))
    rows = corpus.table.where("row is not null").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return rows.join(gained, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups")
