"""From raw documents to token ids: the text operators one after another.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; ``run`` writes each stage's rows in the shared folder and reads them
again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import compression_quality, line_dedup, mixing, sentence_pieces, shingle_join
from gridloom.llm.tables import materialize, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    return compression_quality.accepted(docs, read(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in one; the text and its length change."""
    return line_dedup.without_common_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 80 % of their five-word shingles, the smallest doc_id stays."""
    return shingle_join.one_of_each(docs, k=5, num=80, den=100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target asks for."""
    return mixing.mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, checked by decoding them again."""
    encoded = sentence_pieces.encode(docs.select("doc_id", "source", "text"), check=True)
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

#: Compressed sizes and BPE have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
