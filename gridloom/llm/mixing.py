"""Mixing sources to target weights.

Words are counted per source; sources in code point order, null last, weigh as
``weights`` says, repeating, and share all words by weight. A target stops at
``most`` times its source's words and the excess is shared out again by weight
until none is above: each target is min(most * size, level * weight) for the
one level at which targets sum to all words, found from running sums over the
table of sources. A source's repetition rate is target / size; a document is
taken floor(rate) times, and once more if the hash of its id, as a uniform
number, is under the fraction.

A null or blank text has size 0 and is never taken more than any other. A
source of no words has target 0 and rate 0. A null doc_id hashes as an empty
string. Rows that share a doc_id share their draw. Sources of equal size by weight
are taken in code point order. An empty table gives no rows. Other columns, whatever their
names, pass through ``mix`` and are ignored by ``plan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize

#: Rows of (source, size, target), about a hundred bytes each.
BROADCAST = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the id's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, target) from rows of (source, size). One row a source, so windows over all of them are small."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    by = by.withColumn("weight", weight)
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    by = by.select(
        "*",
        F.coalesce(F.sum("source_size").over(rising), F.lit(0)).alias("size_below"),
        F.coalesce(F.sum("weight").over(rising), F.lit(0.0)).alias("weight_below"),
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weight_all"),
    )
    # the level if all sources before this one stop at their limit and this and the rest don't
    level = (F.col("total") - most * F.col("size_below")).cast("double") / (F.col("weight_all") - F.col("weight_below"))
    by = by.withColumn("level", F.when(level * F.col("weight") <= most * F.col("source_size"), level))
    by = by.withColumn("level", F.max("level").over(everything))
    limit = (most * F.col("source_size")).cast("double")
    return by.select("source", "source_size", F.least(limit, F.coalesce(F.col("level") * F.col("weight"), limit)).alias("target"))


def _planned(docs: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """row (the input's columns, whatever their names), doc_id, size, source_size, target, copies.

    Up to BROADCAST sources, by count, their table is broadcast, so texts stay
    where they are and a big source skews nothing; beyond, it is a shuffle join.
    """
    sized = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", n_words(F.col("text").cast("string")).alias("size"))
    per_source = materialize(targets(sized.select("source", "size"), weights, most).withColumnRenamed("source", "_source"))
    if per_source.count() <= BROADCAST:
        per_source = F.broadcast(per_source)
    joined = sized.join(per_source, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (uniform(F.col("doc_id")) < rate - F.floor(rate)).cast("long")
    return joined.select("row", "doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"))


def plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target and copies, how often the mix takes the document."""
    return _planned(docs.select("doc_id", "text", "source"), weights, most).drop("row")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the input's columns."""
    planned = _planned(docs, weights, most).where("copies > 0")
    return planned.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).select("row.*")
