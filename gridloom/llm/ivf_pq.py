"""Approximate nearest neighbours: an inverted file with product-quantised residuals.

Unit vectors are assigned to the nearest of a set of coarse centroids; what is
left of each is cut into short parts, each coded by a codebook of 256 words. A
query visits the lists nearest to it; the number of lists is measured on a
bounded sample so that they hold ``recall`` of the true neighbours, and a query
goes on until its lists hold k other vectors or all are visited. In a list,
a table of the query's squared distances to all codewords gives every vector's
asymmetric distance as a sum of look-ups. A vector's coding error is stored
with it, so distance minus error bounds its true distance from below: whatever
can still be among the k nearest is reranked with the original vectors in
double precision, however many that are. Lists are cut into blocks of bounded
size, and the queries stream past each block.

Vectors that are null, empty, zero, hold null or non-finite components, or
differ in length from the most common one, take no part; neither do rows
without an id. Rows that share an id are separate candidates, but never their own
query's; a query's id asks once, with the smallest of its vectors in array order,
and all its rows are its own. Ties go to the smaller vec_id. An empty table gives
no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors as V
from .tables import materialize, ship

SAMPLE = 20_000
BLOCK = 2048
#: Queries that are worked on at a time.
QUERIES = 64
PART, CODES = 4, 256
#: Lists that can be fitted on the sample, five vectors each. Lists grow with the table, and are cut into blocks.
LISTS = SAMPLE // 5


class Index(NamedTuple):
    dim: int
    centers: np.ndarray
    #: one codebook for each part of the residual
    books: list[np.ndarray]
    probes: int


def parts(dim: int) -> list[slice]:
    return [slice(a, min(a + PART, dim)) for a in range(0, dim, PART)]


def build(sample: np.ndarray, lists: int, k: int, recall: float) -> Index:
    """Fit on a bounded sample of unit vectors, and measure how many lists hold the neighbours."""
    centers = V.k_means(sample, lists)
    near = V.nearest_center(sample, centers)
    residual = sample - centers[near]
    books = [V.k_means(residual[:, p], CODES, 8) for p in parts(sample.shape[1])]
    asked = np.arange(0, len(sample), max(1, len(sample) // 500))
    likeness = sample[asked] @ sample.T
    likeness[np.arange(len(asked)), asked] = -np.inf
    top = np.argsort(-likeness, axis=1)[:, : min(k, max(len(sample) - 1, 1))]
    order = np.argsort(V.distances(sample[asked], centers), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centers))[None, :], axis=1)
    probes = int(np.quantile(np.take_along_axis(rank, near[top], axis=1), recall, method="higher")) + 1
    return Index(sample.shape[1], centers, books, probes)


def encode(index: Index, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List, codes and coding error of unit vectors."""
    near = V.nearest_center(x, index.centers)
    residual = x - index.centers[near]
    codes = np.stack([V.nearest_center(residual[:, p], book) for p, book in zip(parts(index.dim), index.books, strict=True)], axis=1)
    back = np.concatenate([book[codes[:, i]] for i, book in enumerate(index.books)], axis=1)
    return near, codes.astype(np.uint8), np.linalg.norm(residual - back, axis=1)


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near, codes, error = encode(index, V.unit(V.matrix(batch.column("v"), index.dim)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                names=["vec_id", "v", "list", "code", "error"],
            )

    return run


def _probe(shared, k: int, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = V.unit(V.matrix(batch.column("v"), index.dim))
            order = np.argsort(V.distances(x, index.centers), axis=1, kind="stable")
            needed = k + batch.column("own").to_numpy()  # a query's own rows are none of its neighbours
            visits = np.maximum(index.probes, 1 + (np.cumsum(counts[order], axis=1) < needed[:, None]).sum(axis=1))
            lists = [o[:n].tolist() for o, n in zip(order.astype(np.int32), visits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(lists, pa.list_(pa.int32()))], names=["vec_id", "v", "lists"])

    return run


def search_block(index: Index, center: np.ndarray, block: tuple, queries: tuple, k: int) -> Iterator[tuple[int, int, float]]:
    """(query, vector, cosine) of each query's k nearest in a block.

    block: ids (ascending), original vectors, codes, coding errors; queries: ids, original vectors.
    """
    ids, original, codes, error = block
    asked, wanted = queries
    residual = V.unit(wanted) - center
    original, wanted = V.scaled(original), V.scaled(wanted)
    norm = np.sqrt((original * original).sum(axis=1))
    far = np.zeros((len(asked), len(ids)))
    for i, (p, book) in enumerate(zip(parts(index.dim), index.books, strict=True)):
        far += V.distances(residual[:, p], book)[:, codes[:, i]]
    far = np.sqrt(far)
    own = ids[None, :] == asked[:, None]
    worst = np.where(own, np.inf, far + error[None, :])
    bound = np.partition(worst, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
    able = ~own & (far - error[None, :] <= bound[:, None] + 1e-9)
    for q in range(len(asked)):
        at = np.flatnonzero(able[q])
        size = np.sqrt((wanted[q] * wanted[q]).sum())
        cosine = (original[at] * wanted[q]).sum(axis=1) / (norm[at] * size)
        for j in np.lexsort((ids[at], -cosine))[:k].tolist():
            yield int(asked[q]), int(ids[at[j]]), float(cosine[j])


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        key, held, block, queries = None, [], None, []

        def ask() -> pa.RecordBatch:
            asked = (np.array([r[4] for r in queries]), np.array([r[5] for r in queries], dtype=np.float64))
            found = list(search_block(index, index.centers[key[0]], block, asked, k)) if block else []
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for row in zip(*(c.to_numpy(zero_copy_only=False) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    if queries:
                        yield ask()
                    key, held, block, queries = row[:2], [], None, []
                if not row[3]:  # the block's vectors come first
                    held.append(row)
                    continue
                if held:
                    block = (np.array([r[4] for r in held]), np.array([r[5] for r in held], dtype=np.float64), np.stack([np.frombuffer(r[6], dtype=np.uint8) for r in held]), np.array([r[7] for r in held]))
                    held = []
                queries.append(row)
                if len(queries) >= QUERIES:
                    yield ask()
                    queries = []
        if queries:
            yield ask()

    return run


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, recall: float = 0.98) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by cosine, ties to the smaller vec_id."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(V.usable(F.col("v")) & F.col("vec_id").isNotNull())
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == most["dim"])
    lists = max(1, min(LISTS, round(most["count"] ** 0.5 / 2)))
    index = build(V.bounded_sample(rows, "vec_id", SAMPLE), lists, k, recall)
    shared = spark.sparkContext.broadcast(index)
    coded = materialize(rows.mapInArrow(_encode(shared), "vec_id long, v array<double>, list int, code binary, error double"))
    sizes = coded.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    counts = np.zeros(len(index.centers), dtype=np.int64)
    for r in coded.groupBy("list").count().collect():  # a row a list, LISTS at most
        counts[r["list"]] = r["count"]
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own"))
    probes = asked.mapInArrow(_probe(shared, k, counts), "vec_id long, v array<double>, lists array<int>").select("vec_id", "v", F.explode("lists").alias("list"))
    probes = probes.join(sizes, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("n"), F.lit(True).alias("asks"), "vec_id", "v")
    homes = coded.join(sizes, "list").select("list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("n"), F.lit(False).alias("asks"), "vec_id", "v", "code", "error")
    dealt = homes.unionByName(probes, allowMissingColumns=True).repartition("list", "block").sortWithinPartitions("list", "block", "asks", "vec_id")
    found = dealt.mapInArrow(_search(shared, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
