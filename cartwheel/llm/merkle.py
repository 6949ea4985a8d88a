"""A Merkle manifest of a dataset: nested-interval labels, containment joins, sibling proofs.

A row is a leaf: the SHA-256 of its fields.  The leaves of a tree (one tree for each value of
the group column) are ranked, and every node carries the interval [lo, hi] of leaf ranks that
it covers.  A node is the digest of up to ``FANOUT`` consecutive nodes of the level below;
the node whose interval is the whole tree is its subroot.  The subroots, ordered by
group, are the leaves of a last tree, whose top is the root.

``build`` works bottom-up: one grouping a level, of at most FANOUT rows a group, each level a
written table an eighth of the one below.  ``prove`` works top-down: the nodes of a level meet
their parents by (tree, bucket of the parent's level) and containment of the intervals; the
parent's children outside the node's own interval, to its left and to its right, are the
siblings.  Nodes hand their path down, so a leaf meets one row, its parent, and never
the whole tree.

Ranks come from a distributed numbering; a tree that holds most rows is spread over
many tasks, as keys are (tree, bucket), never the tree alone.

Defined cases: a null field is ``-`` in the leaf; rows with a null group are a tree of their
own, before the others; null ids come before the others; rows that repeat an id are ordered by
their leaves (equal leaves may swap ranks, which changes no digest, and each has its own proof); a
tree of one leaf has that leaf as subroot and no siblings there; proofs without any
sibling are the digest of the empty string; an empty table gives no leaves and the root null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut
from cartwheel.operators.ranking import row_number

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """UTF-8 byte count, colon, value; ``-`` for null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, CAPITALS, SMALL)


def tree_key(group: Column) -> Column:
    """A key that is never null and sorts like the group: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


@dataclass
class Manifest:
    """Written tables of a dataset's trees.

    leaves  tree, lo, hi, size (leaves of the tree), digest, and the columns that were carried along
    levels  one table a level: tree, lo, hi, size, digest, children (lo, hi, digest)
    tops    the last tree's leaves: tree '', lo, hi, size, digest, named (the tree whose subroot it is)
    above   the levels over them
    root    the root's digest, None for an empty table
    """
    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame
    above: list[DataFrame]
    root: str | None


def _top() -> Column:
    return F.col("hi") - F.col("lo") + 1 == F.col("size")


def _levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes over the leaves, a table a level; a tree leaves the loop with its top."""
    largest = leaves.agg(F.max("size")).first()[0] or 0
    nodes, levels, span = leaves, [], 1
    while span < largest:
        span *= fanout
        child = F.struct("lo", "hi", "digest")
        nodes = nodes.where(~_top()).groupBy("tree", "size", F.expr(f"lo div {span}").alias("bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_sort(F.collect_list(child)).alias("children"))
        nodes = cut(nodes.select("tree", "lo", "hi", "size", F.sha2(F.array_join("children.digest", ""), 256).alias("digest"),
                                 "children"), "merkle-level")
        levels.append(nodes)
    return levels


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    tops = leaves.where(_top()).select("tree", "digest")
    for nodes in levels:
        tops = tops.union(nodes.where(_top()).select("tree", "digest"))
    return tops


def build(rows: DataFrame, order: list[str], fanout: int = FANOUT) -> Manifest:
    """The manifest of ``rows``: columns tree (see ``tree_key``) and digest, the order columns within a tree, and any others."""
    rows = rows.withColumn("digest", F.col("digest").cast("string"))
    ranked = row_number(rows, [*order, "digest"], partition_by=["tree"], rn_col="lo", size_col="size")
    leaves = cut(ranked.withColumns({"lo": F.col("lo") - 1, "hi": F.col("lo") - 1}), "merkle-leaves")
    levels = _levels(leaves, fanout)
    named = row_number(_tops(leaves, levels).withColumnRenamed("tree", "named").withColumn("tree", F.lit("")),
                       ["named"], partition_by=["tree"], rn_col="lo", size_col="size")
    tops = cut(named.withColumns({"lo": F.col("lo") - 1, "hi": F.col("lo") - 1}), "merkle-tops")
    above = _levels(tops, fanout)
    root = _tops(tops, above).first()  # a single row: the last tree's top
    return Manifest(leaves, levels, tops, above, root["digest"] if root else None)


def _joined(side: Column) -> Column:
    return F.array_join(F.transform(side, lambda c: c["digest"]), "")


def _attach(nodes: DataFrame, parents: DataFrame, span: int) -> DataFrame:
    """Nodes with the path and subroot of their parent, their own siblings put before it.

    The bucket makes it an equality join; containment of the intervals holds the pair.
    """
    up = parents.select(F.col("tree").alias("_tree"), F.expr(f"lo div {span}").alias("_bucket"), F.col("lo").alias("_lo"),
                        F.col("hi").alias("_hi"), F.col("children").alias("_children"), F.col("path").alias("_path"), "subroot")
    met = nodes.join(up, (F.col("tree") == F.col("_tree")) & (F.expr(f"lo div {span}") == F.col("_bucket"))
                     & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
    left = F.filter("_children", lambda c: c["hi"] < F.col("lo"))
    right = F.filter("_children", lambda c: c["lo"] > F.col("hi"))
    step = F.struct(_joined(left).alias("left"), _joined(right).alias("right"))
    return met.withColumn("path", F.concat(F.array(step), "_path"))


def _descend(leaves: DataFrame, levels: list[DataFrame], starts: DataFrame | None, fanout: int) -> DataFrame:
    """Leaves with path and subroot; ``starts`` has the path and subroot of each tree's top (None: nothing is above it)."""
    if starts is not None:
        starts = starts.select(F.col("tree").alias("_start"), F.col("path"), F.col("subroot"))
    above = None
    for k in range(len(levels), -1, -1):
        all_nodes = levels[k - 1] if k else leaves
        kept = [*all_nodes.columns, "path", "subroot"]
        nodes = all_nodes.where(_top())
        if starts is None:
            nodes = nodes.withColumns({"path": F.array().cast(PATH), "subroot": F.col("digest")})
        else:
            nodes = nodes.join(starts, F.col("tree") == F.col("_start")).select(*kept)
        if above is not None:
            nodes = nodes.union(_attach(all_nodes.where(~_top()), above, fanout ** (k + 1)).select(*kept))
        above = cut(nodes, "merkle-paths") if k else nodes
    return above


def prove(manifest: Manifest, fanout: int = FANOUT) -> DataFrame:
    """The leaves (with the columns carried along), each with its subroot and its path to the root.

    path: for every level from the leaf to the root, the joined digests of the siblings to the
    left and to the right.
    """
    tops = _descend(manifest.tops, manifest.above, None, fanout)
    starts = cut(tops.select(F.col("named").alias("tree"), "path", F.col("digest").alias("subroot")), "merkle-starts")
    return _descend(manifest.leaves, manifest.levels, starts, fanout)


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level and left to right, as one digest."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda node, p: digest(p["left"], node, p["right"]))


def verify(docs: DataFrame, tampered: Column, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, path, folded_root and verified of every document.

    ``tampered`` is the text that a later reader sees: its leaf is folded up the original siblings.
    """
    values = [F.col(c) for c in FIELDS]
    seen = leaf(*values[:-1], tampered)
    rows = docs.select(tree_key(F.col("lang")).alias("tree"), "doc_id", leaf(*values).alias("digest"), seen.alias("seen"))
    manifest = build(rows, ["doc_id"], fanout)
    folded = prove(manifest, fanout).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(manifest.root).cast("string").alias("root"), "path",
        fold(F.col("seen"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def in_tampered_sample(doc_id: Column) -> Column:
    """3 divides the crc32 of the decimal doc_id; false without one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))
