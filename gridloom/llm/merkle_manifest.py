"""A Merkle manifest of a dataset: a root over all rows, and for each row what proves it.

Each row is a leaf. Per group (language) the leaves stand in order of their ids; every
8 consecutive nodes become their parent until one is left, the group's subroot, and
the subroots become the root by the same rule.

A level is kept as strings: an aligned block of 512 nodes is one row whose levels are
hex digests one after another. Parents are hashes of substrings of fixed width, a
node's siblings are the two substrings beside it. Three levels are raised in a
block; the blocks' tops are the nodes of the next round, so the rounds are few (four
for 10^11 rows) and no row holds more than 512 nodes. The way back hands each block
the siblings above it.

Places are running numbers: rows are sorted in ranges of (group, id, leaf), counted
per range and offset by the counts before, so that a language of most rows is spread
over as many tasks as it needs. All is done by DataFrame functions.

Nulls are written ``-`` and group null is a group, the first; rows without an id
come first in their group, rows that share one stand in order of their leaves, and
repeated rows are leaves of their own. An empty text isn't a null one. A lone row is
its subroot, a lone subroot the root; without siblings a proof is the hash of nothing.
An empty table gives no rows. Very long texts are hashed whole. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialize, ship

#: Nodes that become one parent, and levels that are raised within a block.
ARITY, LEVELS = 8, 3
BLOCK = ARITY**LEVELS
#: Hex digits of a digest.
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def written(value: Column) -> Column:
    """A field as a leaf hashes it: its bytes are counted, so no two rows are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    return digest(F.concat(*(written(changed.get(c, F.col(c))) for c in FIELDS)))


def leaves(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "lang", leaf_of().alias("leaf"))


def tampered(docs: DataFrame) -> DataFrame:
    """The leaves, and ``other``, that of a row whose text was put into lower case, where 3 divides its id's checksum."""
    touched = F.col("text").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return docs.select("doc_id", "lang", leaf_of().alias("leaf"), F.when(touched, leaf_of(text=F.translate("text", UPPER, LOWER))).alias("other"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with _pos, the place in its group (null is a group), and _n, the group's size. The result is written."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    sorted_ = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = sorted_.groupBy(F.col(group).alias("_g"), part.alias("_part")).agg(F.count("*").alias("_m"), F.min("_at").alias("_first"))
    before = "coalesce(sum(_m) over (partition by _g order by _part rows between unbounded preceding and 1 preceding), 0)"
    counts = counts.select("_g", "_part", "_first", F.expr(before).alias("_before"), F.expr("sum(_m) over (partition by _g)").alias("_n"))
    joined = sorted_.withColumn("_own", part).join(counts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_own") == F.col("_part")))
    return joined.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("_pos"), "_n")


def parents(level: Column) -> Column:
    """The level above: the hash of each ARITY digests, a shorter run at the end included."""
    run = ARITY * WIDTH
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)), "").cast("binary")


def with_levels(blocks: DataFrame) -> DataFrame:
    """Blocks (_items in order, _n nodes in the whole level) with the levels' strings _l0 to _l3, null above the top."""
    out = blocks.withColumn("_l0", F.array_join(F.transform("_items", lambda x: x["digest"]), "").cast("binary"))
    for k in range(LEVELS):
        out = out.withColumn(f"_l{k + 1}", F.when(F.col("_n") > ARITY**k, parents(F.col(f"_l{k}"))))
    return out


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """Written tables of blocks, round by round: _g, _block, _n, _items, _top, until a group is one block.

    nodes: _g, _pos, _n and item, a struct with a digest.
    """
    out = []
    most = nodes.agg(F.max("_n")).first()[0] or 0
    while True:
        block = F.floor(F.col("_pos") / BLOCK).cast("long").alias("_block")
        blocks = nodes.groupBy("_g", block, "_n").agg(F.array_sort(F.collect_list(F.struct("_pos", "item"))).alias("_items"))
        blocks = with_levels(blocks.withColumn("_items", F.col("_items.item")))
        top = F.coalesce(*(F.col(f"_l{k}") for k in range(LEVELS, -1, -1))).cast("string")
        out.append(materialize(blocks.select("_g", "_block", "_n", "_items", top.alias("_top"))))
        if most <= BLOCK:
            return out
        most = -(-most // BLOCK)
        nodes = out[-1].select("_g", F.col("_block").alias("_pos"), F.ceil(F.col("_n") / BLOCK).alias("_n"), F.struct(F.col("_top").alias("digest")).alias("item"))


def siblings(level: int, at: Column) -> Column:
    """The digests left and right of a node's own in its run, at the level above the leaf at place ``at``; null above the top."""
    string, own = F.col(f"_l{level}"), F.floor(at / ARITY**level).cast("int")
    inside = own % ARITY
    left = F.substring(string, (own - inside) * WIDTH + 1, inside * WIDTH)
    right = F.substring(string, (own + 1) * WIDTH + 1, (ARITY - 1 - inside) * WIDTH)
    return F.when(F.col("_n") > ARITY**level, F.struct(left.cast("string").alias("left"), right.cast("string").alias("right")))


def paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Down again: each item of the first round with ``path``, its siblings level by level.

    tops: _g, path (what is above the group's top) and columns that are handed down.
    """
    above = tops.withColumn("_block", F.lit(0).cast("long"))
    handed = [c for c in above.columns if c not in ("_g", "_block", "path")]
    for blocks in reversed(levels):
        up = above.select(F.col("_g").alias("_ug"), F.col("_block").alias("_ub"), F.col("path").alias("_above"), *handed)
        joined = with_levels(blocks).join(up, F.col("_g").eqNullSafe(F.col("_ug")) & (F.col("_block") == F.col("_ub")))
        each = joined.select("*", F.posexplode("_items").alias("_at", "_item"))
        own = F.filter(F.array(*(siblings(k, F.col("_at")) for k in range(LEVELS))), lambda s: s.isNotNull())
        above = each.select("_g", (F.col("_block") * BLOCK + F.col("_at")).alias("_block"), F.concat(own, "_above").alias("path"), *handed, "_item")
    return above


def tree(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``leaves`` (with a column leaf) with subroot, root and path, an array of (left, right) siblings up to the root.

    The groups' order in the root is by bytes, null first.
    """
    ship(leaves.sparkSession)
    kept = [c for c in leaves.columns if c != "leaf"]
    rows = materialize(leaves.withColumn("_row", F.monotonically_increasing_id()))  # repeated rows are told apart by it
    nodes = numbered(rows, group, [*order, "leaf", "_row"])
    levels = rounds(nodes.select(F.col(group).alias("_g"), "_pos", "_n", F.struct(*kept, F.col("leaf").alias("digest")).alias("item")))
    subroots = levels[-1].select(F.col("_g").alias("_sub"), F.col("_top").alias("subroot"), F.lit(0).alias("_all"))
    over = rounds(numbered(subroots, "_all", ["_sub"]).select(F.col("_all").alias("_g"), "_pos", "_n", F.struct("_sub", F.col("subroot").alias("digest")).alias("item")))
    step = "array<struct<left:string,right:string>>"
    roots = paths(over, over[-1].select("_g", F.col("_top").alias("root"), F.array().cast(step).alias("path")))
    tops = materialize(roots.select(F.col("_item._sub").alias("_g"), F.col("_item.digest").alias("subroot"), "root", "path"))
    return paths(levels, tops).select(*(F.col(f"_item.{c}").alias(c) for c in kept), F.col("_item.digest").alias("leaf"), "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proof(path: Column) -> Column:
    """The siblings' digests, level by level from left to right, as one string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, leaf, subroot, root and proof (hex digests one after another)."""
    return tree(leaves(docs), "lang", ["doc_id"]).select("doc_id", "lang", "leaf", "subroot", "root", proof(F.col("path")).alias("proof"))


def audit(docs: DataFrame) -> DataFrame:
    """Every row's proof tried on the row as ``tampered`` leaves it: folded_root, and whether it is the root."""
    rows = tree(tampered(docs), "lang", ["doc_id"])
    out = rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof"), folded(F.coalesce("other", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
