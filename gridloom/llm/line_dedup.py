"""Line dedup with DataFrame functions only.

A line's key is the line without ASCII white space at its ends, A-Z
lower-cased. Keys of at least ``min_chars`` code points that ``min_docs``
documents hold are dropped everywhere but in the largest doc_id that holds
them. Only 128-bit hashes of keys are shuffled. Counting distinct documents
deals one row for each (key, document) by both, so a line in every document is
counted by all tasks; the commonest keys are broadcast back to the lines
(``skew_join``), the others join by key. The dropped lines' positions return to
the document as one array, and the text is reassembled by position in a single pass.

A null text is one empty line. A row without a doc_id counts for no line and
keeps all of its own. Rows that share a doc_id are one document for counting,
each losing its own lines. Lines of any length are keyed whole. Ties don't arise:
the largest doc_id keeps all its lines of a key. An empty table gives no rows.
Other columns, whatever their names, pass through ``without_common_lines`` and are
ignored by ``dedup_lines``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialize, skew_join

SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() does just that for text that is all ASCII, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    docs = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    docs = docs.where(F.octet_length("line") >= min_chars).select("doc_id", "version", "pos", F.btrim("line", F.lit(SPACE)).alias("line"))
    docs = docs.where(F.char_length("line") >= min_chars).select("doc_id", "version", "pos", ascii_lower(F.col("line")).alias("key"))
    return docs.select("doc_id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, version, gone): sorted positions of the lines that each text loses."""
    lines = _long_lines(docs, min_chars)
    common = materialize(lines.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs))
    gone = skew_join(lines, common, ["h1", "h2"], "n", ["doc_id", "pos"]).where("doc_id <> keeper")
    return gone.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def _joined(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """row (the input's columns, whatever their names), doc_id, text, gone, and kept where lines are gone."""
    gone = dropped_lines(_identified(docs), min_chars, min_docs).select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "gone")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # merge: one plan at every size, rather than a broadcast that stops being possible
    joined = rows.join(gone.hint("merge"), (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_version")), "left").drop("_doc", "_version")
    # positions -> one flag a line, so that a line looks itself up in constant time
    gap = lambda p, i: p - F.coalesce(F.get("gone", i - 1), F.lit(-1)) - 1
    flags = F.flatten(F.transform("gone", lambda p, i: F.concat(F.array_repeat(F.lit(False), gap(p, i)), F.array(F.lit(True)))))
    joined = joined.withColumn("flags", F.when(F.col("gone").isNotNull(), flags))
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda _, i: ~F.coalesce(F.get("flags", i), F.lit(False))), "\n")
    return joined.withColumn("kept", F.when(F.col("gone").isNotNull(), kept))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped and kept, the text without its dropped lines."""
    newlines = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return _joined(docs.select("doc_id", "text"), min_chars, min_docs).select(
        "doc_id",
        (newlines + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("kept", "text").alias("kept"),
    )


def without_common_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The input's rows and columns; where lines were dropped, text is what is left and n_chars its length."""
    new = {"text": F.coalesce(F.col("kept"), F.col("row.text").cast("string"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.char_length("kept").cast("long"), F.col("row.n_chars").cast("long"))
    joined = _joined(docs, min_chars, min_docs)
    return joined.select(*((new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
