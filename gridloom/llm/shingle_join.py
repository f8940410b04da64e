"""N-gram Jaccard join by PartEnum signatures.

A text's set holds the hashes of its distinct k-word shingles. Sets of sizes s
and t with similarity of at least g differ in at most (s + t)(1 - g)/(1 + g)
elements. Sizes are cut into bands; in a band two similar sets differ in k
elements at most. The hash domain is cut into n1 first-level parts of n2 = 3
second-level parts each, and a set signs with every subset of n2 - k2 = 2 of a
first-level part's three: parts in which two sets differ in one element at most
agree on a subset. n1 is larger than pigeonholes ask for, so similar sets agree
on G signatures at least: each difference spoils two of a part's three subsets
if it is the part's first and the last one if it is the second, so G is
2 n1 - k, or 3 n1 - 2 k for k < n1. Each set leaves out its G - 1 emptiest
subsets, ties by place: agreed subsets are equally full in both sets, so the
fullest that the two agree on is left out by neither. A set signs for its own
band and, if a similar set could be that large, for the next.

Sets that share a signature are compared by parity sketches, a few bits for each
element: sketches differ in at most as many bits as the sets in elements, so
whatever differs in more bits than two similar sets may is no link, and nothing
else is dropped. What is left chains sets into clusters; clusters are cut into
blocks of bounded size, and blocks meet in pairs in a task that counts
intersections exactly. Both steps return spanning forests instead of pairs.
Copies are one set throughout: they are collapsed by set before any pair is
looked at. No candidate is capped.

Null or blank texts have an empty set and link with nothing; rows without a
doc_id neither. Rows that share a doc_id are compared and grouped by their own
texts, told apart by a 64-bit hash of the text. Repeated rows get the same group;
ties in a group go to the smallest doc_id. Very long texts stand alone in a block.
An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .linking import forest
from .tables import components, materialize, ship, skew_join

#: Shingles in a block of a cluster, and the most texts that it holds.
BLOCK_SHINGLES, BLOCK_TEXTS = 200_000, 500
#: Sketches of a signature's group that meet in one task.
GROUP = 1024
#: Sets remembered by a task so that copies sign once; forgetting one only costs a few rows.
REMEMBERED = 100_000
#: Second-level parts, and the differences that a first-level part forgives.
N2, K2 = 3, 1
SUBSETS = tuple(combinations(range(N2), N2 - K2))
#: Share of first-level parts beyond those needed, so that sets can leave out their emptiest subsets.
SPARE = 0.3
_SEEDS = np.array([0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03], dtype=np.uint64)


def band_starts(limit: int, num: int, den: int) -> list[int]:
    """Smallest sizes of the bands up to the first above ``limit``; wider bands for lower similarity."""
    ratio, out = (den / num) ** 3, [1]
    while out[-1] <= limit:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * ratio))))
    return out


_BANDS: dict[tuple[int, int], list[int]] = {}


def _bands(limit: int, num: int, den: int) -> list[int]:
    known = _BANDS.get((num, den), [])
    if len(known) < 3 or known[-3] <= limit:
        known = _BANDS[num, den] = band_starts(4 * limit + 1000, num, den)
    return known


def part_plan(differ: int) -> tuple[int, int, int]:
    """For sets that differ in ``differ`` elements at most: (n1, n2, how many subsets of parts a set may leave out)."""
    if not differ:
        return 1, 1, 0
    n1 = int(np.ceil((1 + SPARE) * (differ + 1) / (K2 + 1)))
    agreed = 2 * n1 - differ if differ >= n1 else 3 * n1 - 2 * differ
    return n1, N2, agreed - 1


def signatures(elements: np.ndarray, num: int, den: int) -> np.ndarray:
    """PartEnum signatures of a set (sorted hashes) for similarity of num/den and more."""
    n = len(elements)
    starts = _bands(n, num, den)
    own = int(np.searchsorted(starts, n, side="right")) - 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(H.mix(elements ^ _SEEDS[2]), out=total[1:])
    out = []
    for band in (own, own + 1):
        if band > own and n * den // num < starts[band]:
            break
        n1, n2, spare = part_plan(2 * (starts[band + 1] - 1) * (den - num) // (den + num))
        parts = n1 * n2
        cuts = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts if parts > 1 else 0)
        edges = np.concatenate(([0], np.searchsorted(elements, cuts), [n]))
        sums, sizes = (total[edges[1:]] - total[edges[:-1]]).reshape(n1, n2), np.diff(edges).reshape(n1, n2)
        subsets = SUBSETS if n2 > 1 else ((0,),)
        content = np.stack([sums[:, list(c)].sum(axis=1) for c in subsets], axis=1).ravel()
        filled = np.stack([sizes[:, list(c)].sum(axis=1) for c in subsets], axis=1).ravel()
        name = H.mix(np.arange(1, len(content) + 1, dtype=np.uint64) * _SEEDS[3] + np.uint64(band))
        out.append(H.mix(content ^ name)[np.argsort(filled, kind="stable")[spare:]])
    return np.concatenate(out)


def parity_sketch(elements: np.ndarray) -> bytes:
    """One bit for each of a power of two of ranges of the hash domain, two for each element at least: is their number odd?"""
    bits = max(64, 1 << (2 * len(elements) - 1).bit_length())
    odd = np.bincount((elements >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, words: int) -> np.ndarray:
    """A sketch cut down to ``words`` 64-bit words: neighbouring ranges become one, so parities add up."""
    bits = np.unpackbits(np.frombuffer(sketch, dtype=np.uint8), bitorder="little")
    while len(bits) > 64 * words:
        bits = bits[::2] ^ bits[1::2]
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _alike(num: int, den: int):
    """Groups of sets that share a signature -> a forest of the pairs whose sketches allow a link."""

    def group(rows: list[tuple]) -> list[tuple[int, int]]:
        low, high = rows[0][1], rows[0][2]
        words = min(len(r[6]) for r in rows) // 8
        x = np.stack([folded(r[6], words) for r in rows])
        size, bucket = np.array([r[5] for r in rows]), np.array([r[3] for r in rows])
        one, two = np.flatnonzero(bucket == low), np.flatnonzero(bucket == high)
        hit = np.zeros((len(one), len(two)), dtype=bool)
        for k, i in enumerate(one.tolist()):
            apart = np.bitwise_count(x[two] ^ x[i]).sum(axis=1, dtype=np.int64)
            hit[k] = (apart <= (size[two] + size[i]) * (den - num) // (den + num)) & (two != i)
        return [(rows[one[i]][4], rows[two[j]][4]) for i, j in forest(hit)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []
        for batch in (b.slice(at, 2000) for b in batches for at in range(0, b.num_rows, 2000)):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[-1][:3]:
                    out += group(held)
                    held = []
                held.append(row)
        if held:
            out += group(held)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return run


def shingle_sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each row's text, A-Z lower-cased."""
    raw, at = H.text_buffers(batch.column("text"))
    for first, last in H.blocks(at):
        starts, words = H.word_hashes(raw, at[first : last + 1], lower=True)
        edges = np.searchsorted(starts, at[first : last + 1])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield np.unique(H.shingle_hashes(words[a:b], k))


def _describe(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            size, one, two, signs, sketches = [], [], [], [], []
            for doc, elements in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch, k), strict=True):
                ids = tuple(int(H.mix(np.add.reduce(H.mix(elements ^ s), keepdims=True) + np.uint64(len(elements)))[0].view(np.int64)) if len(elements) else 0 for s in _SEEDS[:2])
                size.append(len(elements))
                one.append(ids[0])
                two.append(ids[1])
                if doc is None or not len(elements) or ids in seen:  # rows without an id link with nothing and sign for no one
                    signs.append(None)
                    sketches.append(None)
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(ids)
                signs.append(signatures(elements, num, den).view(np.int64))
                sketches.append(parity_sketch(elements))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(signs, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "s1", "s2", "signs", "sketch"],
            )

    return run


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between left and right members (indexes into ``sets``)."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    both = np.zeros((len(left), len(right)), dtype=np.float64)
    to_left, to_right = np.full(len(sets), -1), np.full(len(sets), -1)
    to_left[left], to_right[right] = np.arange(len(left)), np.arange(len(right))
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        c, o = column[a:b] - at, owner[a:b]
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        inside = to_left[o] >= 0
        x[to_left[o[inside]], c[inside]] = 1
        inside = to_right[o] >= 0
        y[to_right[o[inside]], c[inside]] = 1
        both += x @ y.T
    hit = both * den >= num * (size[left][:, None] + size[right][None, :] - both)
    hit &= left[:, None] != right[None, :]
    return [(int(left[i]), int(right[j])) for i, j in forest(hit)]


def _verify(k: int, num: int, den: int):
    def group(rows: list[tuple]) -> list[tuple[int, int]]:
        low, high = rows[0][1], rows[0][2]
        batch = pa.RecordBatch.from_arrays([pa.array([r[6] for r in rows], pa.large_string())], names=["text"])
        sets = list(shingle_sets(batch, k))
        block = np.array([r[3] for r in rows])
        return [(rows[a][4], rows[b][4]) for a, b in _links(sets, np.flatnonzero(block == low), np.flatnonzero(block == high), num, den)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[-1][:3]:
                    out += group(held)
                    held = []
                if not held or row[:6] != held[-1][:6]:  # a row of the input that was repeated
                    held.append(row)
        if held:
            out += group(held)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return run


def _block_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """members with the pairs of blocks that each is in: (cluster, low, high, block, s1, s2)."""
    order = Window.partitionBy("cluster").orderBy("n_shingles", "s1", "s2")
    cost = F.greatest(F.col("n_shingles"), F.lit(BLOCK_SHINGLES // BLOCK_TEXTS))
    members = members.withColumn("block", F.floor((F.sum(cost).over(order) - cost) / F.lit(BLOCK_SHINGLES)).cast("int"))
    sizes = members.groupBy("cluster", "block").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    low = sizes.select("cluster", F.col("block").alias("low"), F.col("most").alias("low_most"))
    high = sizes.select("cluster", F.col("block").alias("high"), F.col("least").alias("high_least"))
    pairs = low.join(high, "cluster").where((F.col("low") <= F.col("high")) & (F.col("high_least") * num <= F.col("low_most") * den))
    pairs = pairs.select("cluster", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    return members.join(pairs, ["cluster", "block"]).select("cluster", "low", "high", "block", "s1", "s2")


def _candidates(described: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of s1 that chain every two sets that share a signature and whose sketches allow a link."""
    same = Window.partitionBy("sign")
    signed = described.select(F.explode("signs").alias("sign"), "s1")
    shared = signed.select("sign", "s1", F.min("s1").over(same).alias("least"), F.max("s1").over(same).alias("most")).where("least <> most")
    shared = materialize(shared.select("sign", "s1").distinct())
    # similar sets share most of their signatures: of groups with the same members one is enough
    members = (F.bit_xor(F.xxhash64(F.lit(k), "s1")).alias(f"m{k}") for k in (1, 2))
    groups = shared.groupBy("sign").agg(F.count(F.lit(1)).alias("n"), *members)
    groups = groups.groupBy("n", "m1", "m2").agg(F.min("sign").alias("sign")).select("sign", F.ceil(F.col("n") / GROUP).cast("int").alias("buckets"))
    sketches = described.select("s1", "n_shingles", "sketch").dropDuplicates(["s1"])
    dealt = shared.join(groups, "sign").join(sketches, "s1").withColumn("bucket", F.pmod(F.xxhash64("s1"), F.col("buckets")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("other")
    dealt = dealt.select("sign", "bucket", "s1", "n_shingles", "sketch", other).select("sign", F.least("bucket", "other").alias("low"), F.greatest("bucket", "other").alias("high"), "bucket", "s1", "n_shingles", "sketch")
    return dealt.repartition("sign", "low", "high").sortWithinPartitions("sign", "low", "high").mapInArrow(_alike(num, den), "a long, b long")


def _grouped(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """One row per input row (doc_id, text): doc_id, text_hash, n_shingles and component_id."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    described = materialize(docs.mapInArrow(_describe(k, num, den), "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, signs array<long>, sketch binary"))
    sets = described.select("doc_id", "text_hash", "n_shingles", "s1", "s2")
    linked = sets.where("n_shingles > 0 and doc_id is not null")
    reps = linked.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), F.min("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("copies"))
    reps = reps.select("s1", "s2", F.col("row.doc_id").alias("rep"), F.col("row.text_hash").alias("text_hash"), "n_shingles", "copies")

    chained = _candidates(described.where("doc_id is not null and signs is not null"), num, den)
    clusters = components(chained).select(F.col("id").alias("s1"), F.col("component").alias("cluster"))

    members = materialize(reps.join(clusters, "s1").select("cluster", "rep", "text_hash", "n_shingles", "s1", "s2"))
    pairs = _block_pairs(members.select("cluster", "n_shingles", "s1", "s2"), num, den)
    # merge: one plan at every size, rather than a broadcast that stops being possible
    own = members.select(F.col("rep").alias("doc_id"), "text_hash", "s1", "s2")
    own_text = docs.join(own.hint("merge"), ["doc_id", "text_hash"]).select("s1", "s2", "text")
    dealt = pairs.join(own_text, ["s1", "s2"]).select("cluster", "low", "high", "block", "s1", "s2", "text")
    dealt = dealt.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high", "block", "s1", "s2")
    found = materialize(components(dealt.mapInArrow(_verify(k, num, den), "a long, b long")).select(F.col("id").alias("s1"), F.col("component").alias("node")))

    placed = members.join(found, "s1").select("s1", "s2", "node", "rep")
    least = placed.groupBy("node").agg(F.min("rep").alias("component"))
    group = reps.join(placed.join(least, "node").select("s1", "s2", "component"), ["s1", "s2"], "left")
    group = materialize(group.select("s1", "s2", F.coalesce("component", "rep").alias("component"), "copies"))
    empty = F.col("n_shingles") == 0
    alone = lambda i: F.xxhash64(F.lit(i), "doc_id", "text_hash")  # noqa: E731  empty sets have no group
    sets = sets.withColumns({s: F.when(~empty, F.col(s)).otherwise(alone(s)) for s in ("s1", "s2")})
    # a text in a third of all rows is one key here
    out = skew_join(sets, group, ["s1", "s2"], "copies", ["doc_id", "text_hash"], "left")
    return out.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per input row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    Two texts link when ``den`` * shared shingles >= ``num`` * all shingles of both.
    """
    return _grouped(docs, k, num, den).drop("text_hash")


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The input's rows whose doc_id is the smallest of its group, one row of each; rows without a doc_id stay."""
    groups = _grouped(docs.select("doc_id", "text"), k, num, den)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_text")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    same = (F.col("doc_id") == F.col("_gone")) & (F.col("text_hash") == F.col("_gone_text"))
    return rows.join(gone.hint("merge"), same, "left_anti").select("row.*")
