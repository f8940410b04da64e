"""The registered queries of the text operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression_quality, ivf_pq, line_dedup, merkle_manifest, mixing, multi_index, page_text, phrase_automata, secret_scan, sentence_pieces, shingle_join, suffix_repeats, token_alignment
from .tables import read


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = compression_quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", compression_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(read(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.suffix_dedup(read(spark, sf_dir, "documents"), min_bytes=400)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.phrase_dedup(read(spark, sf_dir, "documents"), window=35)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ivf_pq.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = sentence_pieces.encode(docs, check=True)
    digest = F.sha2(F.array_join("ids", " ").cast("binary"), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "n_chunks", digest.alias("ids_sha256"), "round_trip")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.plan(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(read(spark, sf_dir, "embeddings"), cosine=0.93)


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(read(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle_manifest.audit(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read(spark, sf_dir, "documents"), groups="sha256").withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compression_quality, op2_ngram_jaccard, op3_suffix_dedup, op4_line_dedup, op5_substring_dedup,
        op6_secret_scan, op7_nearest_neighbours, op8_sentencepiece, op9_mix_sources, op10_embedding_near_dedup,
        op11_page_text, op12_merkle_manifest, op13_token_alignment,
    )
}

_LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), flagged AS (
  SELECT keyed.doc_id, line, pos, common.k IS NOT NULL AND keyed.doc_id <> common.keeper AS gone
  FROM keyed LEFT JOIN common ON keyed.k = common.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(length(regexp_replace(regexp_replace(text, '[^\x20\x09-\x0D]+', 'w', 'g'), '[\x20\x09-\x0D]+', '', 'g')), 0) AS size
  FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS DOUBLE) AS w FROM by_source
), placed AS (
  SELECT *, coalesce(sum(source_size) OVER r, 0) AS size_below, coalesce(sum(w) OVER r, 0.0) AS w_below,
         sum(source_size) OVER () AS total, sum(w) OVER () AS w_all
  FROM weighed
  WINDOW r AS (ORDER BY CAST(source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, CAST(total - 3 * size_below AS DOUBLE) / (w_all - w_below) AS l FROM placed
), level AS (
  SELECT max(l) FILTER (WHERE l * w <= 3 * source_size) AS l FROM levels
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), coalesce(level.l * w, CAST(3 * source_size AS DOUBLE))) AS target
  FROM weighed, level
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM rated
"""

_WORDS = r"""
documents_words AS (
  SELECT doc_id, unnest(regexp_extract_all({text}, '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), 1) AS pos
  FROM documents
)"""

#: reach: who can be reached from whom over the rows (a, b) of links, given in both directions.
_REACH = """
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

_JACCARD = "WITH RECURSIVE" + _WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """, grams AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id) AS n_words, count(*) OVER w AS n, string_agg(word, ' ') OVER w AS gram
  FROM documents_words WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)
), shingles AS (
  SELECT DISTINCT doc_id, gram FROM grams WHERE n = 3 OR (n_words < 3 AND pos = 1)
), sized AS (
  SELECT doc_id, gram, count(*) OVER (PARTITION BY doc_id) AS size FROM shingles
), met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared, any_value(x.size) + any_value(y.size) AS sizes
  FROM sized x JOIN sized y ON x.gram = y.gram AND x.doc_id <> y.doc_id AND 100 * least(x.size, y.size) >= 90 * greatest(x.size, y.size)
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM met WHERE 100 * shared >= 90 * (sizes - shared)
),""" + _REACH + """
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, min(reach.b)) AS component_id
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1) s ON s.doc_id = d.doc_id LEFT JOIN reach ON reach.a = d.doc_id
GROUP BY d.doc_id
"""

_PHRASES = "WITH" + _WORDS.format(text="text") + """, windows AS (
  SELECT *, CASE WHEN count(*) OVER w = 35 THEN string_agg(word, ' ') OVER w END AS seq
  FROM documents_words WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), counted AS (
  SELECT doc_id, pos, word, seq IS NOT NULL AND count(*) OVER (PARTITION BY seq) > 1 AS again FROM windows
), covered AS (
  SELECT doc_id, pos, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted
)
SELECT d.doc_id, count(word) AS n_words, count(word) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered c ON c.doc_id = d.doc_id GROUP BY d.doc_id
"""

#: A string of 400 bytes by the hashes of its parts: lengths double up to 256, and two of 256 bytes, 144 apart, make 400.
_ROWS = "(PARTITION BY doc_id ORDER BY pos)"
_BYTES = """WITH h1 AS (
  SELECT doc_id, unnest(regexp_extract_all(hex(encode(text)), '..')) AS byte, generate_subscripts(regexp_extract_all(hex(encode(text)), '..'), 1) AS pos
  FROM documents
), p1 AS (SELECT doc_id, pos, byte, hash(byte) AS h FROM h1)""" + "".join(
    f", p{2 * n} AS (SELECT doc_id, pos, byte, hash(h, lead(h, {n}) OVER {_ROWS}) AS h FROM p{n})" for n in (1, 2, 4, 8, 16, 32, 64, 128)
) + f""", windows AS (
  SELECT doc_id, pos, byte, CASE WHEN lead(pos, 399) OVER {_ROWS} IS NOT NULL THEN hash(h, lead(h, 144) OVER {_ROWS}) END AS seq FROM p256
), counted AS (
  SELECT doc_id, pos, byte, seq IS NOT NULL AND count(*) OVER (PARTITION BY seq) > 1 AS again FROM windows
), covered AS (
  SELECT doc_id, pos, byte, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) AS gone FROM counted
), runs AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER {_ROWS}, false) AS starts FROM covered
)
SELECT d.doc_id, count(byte) AS n_bytes, count(byte) FILTER (WHERE gone) AS n_removed, count(byte) FILTER (WHERE starts) AS n_spans,
       sha256(from_hex(coalesce(string_agg(byte, '' ORDER BY pos) FILTER (WHERE NOT gone), ''))) AS kept_sha256
FROM documents d LEFT JOIN runs c ON c.doc_id = d.doc_id GROUP BY d.doc_id
"""

_NEAR = """WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.93
),""" + _REACH + """
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, c) AS component_id, vec_id = least(vec_id, c) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY 1) l ON l.a = vec_id LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) r ON r.a = vec_id
"""

#: crc32 of a number's decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))),
  lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _tree(name: str, levels: int) -> str:
    """Nodes {name}0 (g, pos, n, h) raised level by level: {name}K, and {name}sK with the digests beside each node."""
    out = ""
    for k in range(levels):
        out += f""", {name}s{k} AS (
  SELECT *, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WINDOW r AS (PARTITION BY g, pos // 8 ORDER BY pos)
), {name}{k + 1} AS (
  SELECT g, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM {name}{k} GROUP BY g, pos // 8, n
)"""
    return out


def _fold(name: str, levels: int, start: str, g: str, pos: str) -> str:
    """Rows of ``start`` with f, what the node has become, and p, the digests met on the way."""
    out = ""
    for k in range(levels):
        out += f""", {name}f{k} AS (
  SELECT x.* EXCLUDE (f, p), CASE WHEN y.n > 1 THEN sha256(y.l || f || y.r) ELSE f END AS f, p || y.l || y.r AS p
  FROM {start} x JOIN {name}s{k} y ON x.{g} = y.g AND x.{pos} // {8**k} = y.pos
)"""
        start = f"{name}f{k}"
    return out


#: Levels for 8^7 documents of a language, and for 8^3 languages.
_HIGH, _WIDE = 7, 3
_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_MERKLE = f"""WITH leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN text IS NOT NULL AND {_CRC} % 3 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n, 0 AS one FROM leaves
), a0 AS (SELECT g, pos, n, leaf AS h FROM placed)""" + _tree("a", _HIGH) + f""", b0 AS (
  SELECT 0 AS g, g AS pos, count(*) OVER () AS n, h FROM a{_HIGH}
)""" + _tree("b", _WIDE) + ", begin AS (SELECT *, coalesce(other, leaf) AS f, '' AS p FROM placed)" + _fold("a", _HIGH, "begin", "g", "pos") + _fold("b", _WIDE, f"af{_HIGH - 1}", "one", "g") + f"""
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM bf{_WIDE - 1} x JOIN a{_HIGH} s ON s.g = x.g CROSS JOIN b{_WIDE} t
"""

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard": _JACCARD,
    "op3_suffix_dedup": _BYTES,
    "op4_line_dedup": _LINES,
    "op5_substring_dedup": _PHRASES,
    "op9_mix_sources": _MIX,
    "op10_embedding_near_dedup": _NEAR,
    "op12_merkle_manifest": _MERKLE,
}
