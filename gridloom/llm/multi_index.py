"""Embedding near-dedup over an inverted multi-index.

Each half of the unit vectors has a codebook of its own, and a pair of nearest
codewords is a cell of the product grid. A vector visits the cells in the
multi-sequence order of its distances, as many as the target recall needs:
the depth is measured on a bounded sample, on its own linked pairs and on partners
drawn at exactly the linking angle, and is the larger of the two. A pair is tried once, in the cell
of higher number: there its vector lives, and the other one visits. Cells are
cut into blocks of bounded size, and a task verifies one pair of blocks with a
matrix product, returning link counts and a spanning forest instead of pairs.

Vectors are compared only with the same label and length. Identical vectors of
a label are collapsed first and count with their copies. Vectors that are null,
empty, zero or hold null or non-finite components, and those without a label,
link with nothing. Rows that share a vec_id are separate vectors with links of their
own, and repeated rows link with each other. A vector that many rows share, and rows
that take no part, are dealt by row when the groups go back to them. Ties don't arise. An empty table gives no rows. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .linking import forest
from .tables import components, materialize, ship, skew_join

SAMPLE = 20_000
#: Vectors that a cell should hold, and that a block holds at most on average.
CELL, BLOCK = 64, 1024
#: Codewords of each half: the fewest, and as many as can be fitted on the sample. Cells grow beyond, and are cut into blocks.
WORDS = (4, SAMPLE // 40)
TRIALS = 1000


class Index(NamedTuple):
    dim: int
    left: np.ndarray
    right: np.ndarray
    depth: int


def multi_sequence(a: np.ndarray, b: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """The ``depth`` pairs (i, j) with the smallest a[i] + b[j], nearest first."""
    one, two = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    a, b = a.tolist(), b.tolist()
    heap, seen, out = [(a[one[0]] + b[two[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < depth:
        _, i, j = heapq.heappop(heap)
        out.append((one[i], two[j]))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(one) and y < len(two) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (a[one[x]] + b[two[y]], x, y))
    return out


def visited_before(x: np.ndarray, y: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many cells each x visits until it is in the cell of its y."""
    half = left.shape[1]
    a, b = V.distances(x[:, :half], left), V.distances(x[:, half:], right)
    every = np.arange(len(x))
    to = a[every, V.nearest_center(y[:, :half], left)] + b[every, V.nearest_center(y[:, half:], right)]
    b.sort(axis=1)
    return np.array([np.searchsorted(b[k], to[k] - a[k] - 1e-12).sum() + 1 for k in range(len(x))], dtype=np.int64)


def build(sample: np.ndarray, words: int, cosine: float, recall: float) -> Index:
    dim = sample.shape[1]
    half = dim // 2
    left = V.k_means(sample[:, :half], words if half else 1)
    right = V.k_means(sample[:, half:], words)
    random = np.random.default_rng(0)
    x = sample[random.integers(0, len(sample), TRIALS)]
    z = random.standard_normal(x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    y = cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * z / np.where(norm > 0, norm, 1)
    depth = int(np.quantile(visited_before(x, y, left, right), recall, method="higher"))
    one, two = np.nonzero(sample[:TRIALS] @ sample.T >= cosine)
    linked = np.flatnonzero(one != two)
    linked = random.permutation(linked)[:TRIALS]
    if len(linked):
        depth = max(depth, int(np.quantile(visited_before(sample[one[linked]], sample[two[linked]], left, right), recall, method="higher")))
    return Index(dim, left, right, depth)


def _visits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        half = index.dim // 2
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            own, goes = np.zeros(len(dims), dtype=np.int64), [[] for _ in range(len(dims))]
            at = np.flatnonzero(dims == index.dim)
            if len(at):
                x = V.unit(V.matrix(batch.column("v").take(pa.array(at)), index.dim))
                a, b = V.distances(x[:, :half], index.left), V.distances(x[:, half:], index.right)
                own[at] = a.argmin(axis=1) * len(index.right) + b.argmin(axis=1)
                for k, row in enumerate(at.tolist()):
                    cells = (i * len(index.right) + j for i, j in multi_sequence(a[k], b[k], index.depth))
                    goes[row] = [c for c in cells if c > own[row]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own), pa.array(goes, pa.list_(pa.int64()))], names=[*batch.schema.names, "own", "goes"]
            )

    return run


def _verify(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, n = [], [], []
        for rows in V.runs(batches, 5):
            low, high = rows[0][3], rows[0][4]
            x = V.unit(np.array([r[8] for r in rows], dtype=np.float64))
            side = np.array([r[5] for r in rows])
            ids, copies = [r[6] for r in rows], np.array([r[7] for r in rows])
            one, two = np.flatnonzero(side == low), np.flatnonzero(side == high)
            if not len(one) or not len(two):
                continue
            hit = x[one] @ x[two].T >= cosine
            if low == high:
                np.fill_diagonal(hit, False)
            for members, counts in ((one, hit @ copies[two]), (two, copies[one] @ hit))[: 1 if low == high else 2]:
                for i in np.flatnonzero(counts).tolist():
                    a.append(ids[members[i]])
                    b.append(None)
                    n.append(int(counts[i]))
            for i, j in forest(hit):
                a.append(ids[one[i]])
                b.append(ids[two[j]])
                n.append(0)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    return run


def near_duplicates(embeddings: DataFrame, cosine: float = 0.93, recall: float = 0.99) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept (vec_id = component_id)."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("v"))
    good = V.usable(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # rows that take no part get keys of their own: as nulls they would all meet in one task
    rows = rows.withColumn("good", good).withColumn("at", F.monotonically_increasing_id())
    key = lambda i: F.when(F.col("good"), F.xxhash64(F.lit(i), "label", "v")).otherwise(F.xxhash64(F.lit(-i), "vec_id", "at"))
    rows = rows.withColumns({"h1": key(1), "h2": key(2)})
    sets = rows.where("good").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    sets = materialize(sets.withColumn("dim", F.size("v")).withColumn("rep", F.monotonically_increasing_id()))
    by_label = sets.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    most = by_label.groupBy("dim").agg(F.max("n").alias("n"), F.sum("n").alias("all")).orderBy(F.desc("all"), "dim").first()
    if most is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    words = min(WORDS[1], max(WORDS[0], round((most.n / CELL) ** 0.5)))
    sample = V.bounded_sample(sets.where(F.col("dim") == most.dim), "rep", SAMPLE)
    shared = spark.sparkContext.broadcast(build(sample, words, cosine, recall))
    visits = sets.select("label", "dim", "rep", "copies", "v").mapInArrow(_visits(shared), sets.select("label", "dim", "rep", "copies", "v").withColumns({"own": F.lit(0).cast("long"), "goes": F.array(F.lit(0).cast("long"))}).schema)
    visits = materialize(visits)

    cell = ["label", "dim", "cell"]
    homes = visits.withColumn("cell", F.col("own"))
    guests = visits.withColumn("cell", F.explode("goes"))
    blocks = lambda df, name: df.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias(name))
    sizes = materialize(blocks(homes, "nb").join(blocks(guests, "nv"), cell, "left").na.fill(0, ["nv"]))
    spread = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    to = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    home = homes.join(sizes, cell).withColumn("block", spread("nb"))
    home = home.withColumn("to", F.concat(F.transform(upto("nb"), lambda k: to(F.least(k, F.col("block")), F.greatest(k, F.col("block")))), F.transform(upto("nv"), lambda k: to(F.col("nb") + k, F.col("block")))))
    guest = guests.join(sizes, cell).withColumn("block", F.col("nb") + spread("nv"))
    guest = guest.withColumn("to", F.transform(upto("nb"), lambda k: to(F.col("block"), k)))
    pick = [*cell, "block", "rep", "copies", "v"]
    dealt = home.select(*pick, F.explode("to").alias("to")).union(guest.select(*pick, F.explode("to").alias("to")))
    dealt = dealt.select(*cell, "to.low", "to.high", "block", "rep", "copies", "v").repartition(*cell, "low", "high")
    found = materialize(dealt.sortWithinPartitions(*cell, "low", "high", "block", "rep").mapInArrow(_verify(cosine), "a long, b long, n long"))

    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    linked = components(found.where("b is not null").select("a", "b")).withColumnRenamed("id", "rep")
    group = sets.select("h1", "h2", "rep", "least", "copies").join(counts, "rep", "left").join(linked, "rep", "left")
    group = materialize(group.select("h1", "h2", "least", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "rep").alias("in")))
    lowest = group.groupBy("in").agg(F.min("least").alias("component"), F.count("*").alias("sets"))
    group = skew_join(group, materialize(lowest), ["in"], "sets", ["h1", "h2"])
    group = materialize(group.select("h1", "h2", "copies", (F.col("copies") - 1 + F.col("n")).alias("n_links"), "component"))
    out = skew_join(rows.select("vec_id", "h1", "h2", "at"), group, ["h1", "h2"], "copies", ["vec_id", "at"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
