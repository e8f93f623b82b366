"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups, proofs for rows.

Checkpoint and recompute: of each tree only every ``stride``-th level is
written. A proof needs the levels between; they are regenerated for one
aligned subtree (``fanout ** stride`` stored nodes at most) at a time from its
stored descendants, its siblings are emitted, and the nodes are discarded.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import in_order, written

#: Children of a node, and levels between two stored ones.
FANOUT, STRIDE = 16, 2


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as unambiguous text: ``-`` if null, else its length in UTF-8 bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*(field(v) for v in values))


@dataclass
class Manifest:
    """``trees``: stored levels of the groups' trees, (g, pos, height, digest), the first with ``row``, a struct
    of the kept columns; ``crown``: those of the tree over the groups; ``groups``: (g, group, size, height, subroot)."""
    trees: list[DataFrame]
    crown: list[DataFrame]
    groups: DataFrame
    root: DataFrame
    fanout: int
    stride: int


def _height(size: Column, fanout: int) -> Column:
    """Levels above the leaves of a tree with ``size`` leaves."""
    return sum(((size > fanout ** e).cast("int") for e in range(63) if fanout ** e < 1 << 63), F.lit(0))


def _segments(ordered: DataFrame, group: str) -> DataFrame:
    """A row for each group in each part: its first ``at``, the group's rows in earlier parts, its rows in all."""
    parts = ordered.groupBy("part", group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn(
        "size", F.sum("n").over(Window.partitionBy(group)))


def _blocks(nodes: DataFrame, span: int, *more: str) -> DataFrame:
    """Aligned subtrees: (g, block, height, kids), kids in order."""
    return nodes.groupBy("g", F.expr(f"pos div {span}").alias("block")).agg(
        F.first("height").alias("height"), F.sort_array(F.collect_list(F.struct("pos", "digest", *more))).alias("kids"))


def _parents(nodes: Column, fanout: int) -> Column:
    """The next level of an array of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, fanout), ""), 256))


def _levels(blocks: DataFrame, level: int, fanout: int, stride: int) -> DataFrame:
    """Blocks with ``lv0`` .. ``lv<stride>``, their nodes level by level, and ``times``, the levels up to their top."""
    out = blocks.withColumn("times", F.least(F.lit(stride), F.col("height") - level)).withColumn("lv0", F.col("kids.digest"))
    for t in range(stride):
        out = out.withColumn(f"lv{t + 1}", _parents(F.col(f"lv{t}"), fanout))
    return out


def _grow(nodes: DataFrame, fanout: int, stride: int) -> list[DataFrame]:
    """The stored levels above ``nodes`` (g, pos, height, digest), which come first."""
    stored = [nodes]
    top = nodes.agg(F.max("height")).first()[0] or 0
    for level in range(0, top, stride):
        blocks = _levels(_blocks(stored[-1].where(F.col("height") > level), fanout ** stride), level, fanout, stride)
        highest = F.element_at(F.array(*(F.col(f"lv{t + 1}") for t in range(stride))), F.col("times"))
        stored.append(written(blocks.select("g", F.col("block").alias("pos"), "height", highest[0].alias("digest")), "merkle-level"))
    return stored


def _tops(stored: list[DataFrame], stride: int) -> DataFrame:
    """(g, height, digest) of each tree's last node."""
    found = [nodes.where(F.col("height") <= k * stride).select("g", "height", "digest") for k, nodes in enumerate(stored)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def build(df: DataFrame, leaf_of: Column, group_col: str, order_col: str, keep: Sequence[Column] = (),
          fanout: int = FANOUT, stride: int = STRIDE) -> Manifest:
    """The manifest of ``df``: a tree for each value of ``group_col`` over ``leaf_of`` (a hex digest of the row).

    Leaves stand in ascending order of ``order_col``, nulls first, then of
    their digests (rows that repeat in all are alike in all they give).
    Groups stand in bytewise order, the null group first. While more than one
    node remains, every ``fanout`` consecutive ones become the digest of their
    concatenation; a lone leaf is its tree's root. ``keep`` are columns to hand
    on to the proofs; others are not read, and names cannot clash. An empty
    table has no groups and no root.

    Scale: texts are read once, for the leaves; later steps carry digests.
    Rows are put in order by ranges that also split a hot group, repeated ids
    and copies; positions are counted from the parts' row counts. No step has
    more than ``fanout ** stride`` nodes in a group.
    """
    # "n" splits rows that are alike in all other columns.
    narrow = written(df.select(leaf_of.alias("digest"), F.col(f"`{group_col}`").alias("group"), F.col(f"`{order_col}`").alias("key"),
                               F.struct(*keep, F.lit(0).alias("_")).alias("row"), F.monotonically_increasing_id().alias("n")), "merkle-leaves")
    rows = in_order(narrow, ["group", "key", "digest", "n"], "merkle-order")
    segments = written(_segments(rows, "group"), "merkle-segments")
    groups = in_order(segments.groupBy("group").agg(F.sum("n").alias("size")).withColumn("all", F.lit(0)), ["group"], "merkle-order")
    starts = _segments(groups, "all").select("part", "first", "before", F.col("size").alias("groups"))
    groups = written(groups.join(starts, "part").select(
        (F.col("at") - F.col("first") + F.col("before")).alias("g"), "group", "size", _height(F.col("size"), fanout).alias("height"),
        _height(F.col("groups"), fanout).alias("crown")), "merkle-groups")

    named = segments.withColumnRenamed("group", "of").join(groups.select("g", F.col("group").alias("name"), "height"), F.col("of").eqNullSafe(F.col("name")))
    named = named.select(F.col("part").alias("in"), "of", "first", "before", "g", "height")
    placed = rows.join(named, (F.col("part") == F.col("in")) & F.col("group").eqNullSafe(F.col("of")))
    placed = written(placed.select("g", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "height", "digest", "row"), "merkle-nodes")
    trees = _grow(placed, fanout, stride)
    subroots = _tops(trees, stride).select("g", F.col("digest").alias("subroot"))
    groups = written(groups.join(subroots, "g"), "merkle-subroots")
    crown = _grow(groups.select(F.lit(0).alias("g"), F.col("g").alias("pos"), F.col("crown").alias("height"), F.col("subroot").alias("digest")),
                  fanout, stride)
    root = _tops(crown, stride).select(F.col("digest").alias("root"))
    return Manifest(trees, crown, groups.drop("crown"), root, fanout, stride)


def _extract(stored: list[DataFrame], tops: DataFrame, fanout: int, stride: int, more: Sequence[str] = ()) -> DataFrame:
    """(g, pos, digest, path, above, *more) for each node of the lowest level.

    ``tops``: for each tree (g, height, path above its root, above: handed on). From the top down, every aligned
    subtree meets the path of its top and regenerates its inner levels; nothing but paths of stored nodes is written.
    """
    paths = None
    for k in range(len(stored) - 2, -1, -1):
        level = k * stride
        inner = more if k == 0 else ()
        blocks = _levels(_blocks(stored[k].where(F.col("height") > level), fanout ** stride, *inner), level, fanout, stride)

        def around(j: Column, t: int) -> Column:
            """Digests left and right of the ancestor, ``t`` levels up, of node ``j`` of the block."""
            run = F.slice(F.col(f"lv{t}"), F.floor(j / fanout ** (t + 1)).cast("int") * fanout + 1, fanout)
            i = (F.floor(j / fanout ** t) % fanout).cast("int")
            return F.struct(F.array_join(F.slice(run, F.lit(1), i), "").alias("left"),
                            F.array_join(F.slice(run, i + 2, F.lit(fanout)), "").alias("right"))

        inside = blocks.select("g", "block", F.transform("kids", lambda kid, j: F.struct(
            kid.alias("node"), F.slice(F.array(*(around(j, t) for t in range(stride))), F.lit(1), F.col("times")).alias("near"))).alias("kids"))
        upper = tops.where((F.col("height") > level) & (F.col("height") <= level + stride)).select("g", F.lit(0).cast("long").alias("block"), "path", "above")
        if paths is not None:
            upper = upper.unionByName(paths.select("g", F.col("pos").alias("block"), "path", "above"))
        met = inside.join(upper, ["g", "block"]).select("g", F.explode("kids").alias("kid"), "path", "above")
        paths = met.select("g", "kid.node.pos", "kid.node.digest", F.concat("kid.near", "path").alias("path"), "above",
                           *(F.col(f"kid.node.{c}") for c in inner))
        if k:
            paths = written(paths, "merkle-paths")
    lone = stored[0].where(F.col("height") == 0).select("g", "pos", "digest", *more).join(
        tops.where(F.col("height") == 0).select("g", "path", "above"), "g")
    lone = lone.select("g", "pos", "digest", "path", "above", *more)
    return lone if paths is None else paths.unionByName(lone)


def proofs(m: Manifest) -> DataFrame:
    """A row for each leaf: the kept columns, ``leaf``, ``subroot``, ``root``, ``path``.

    ``path``: for each level from the leaf to the root, over the subroot, the
    concatenated digests left and right of the node in its run (both empty for
    a run of one). An empty manifest gives no rows.
    """
    root = m.root.select(F.lit(0).alias("g"), F.col("root").alias("above"))
    heights = _tops(m.crown, m.stride).select("g", "height")
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    crown = _extract(m.crown, heights.join(root, "g").select("g", "height", no_path.alias("path"), "above"), m.fanout, m.stride)
    tops = m.groups.select("g", "height", "subroot").join(crown.select(F.col("pos").alias("g"), "path", F.col("above").alias("root")), "g")
    tops = written(tops.select("g", "height", "path", F.struct("subroot", "root").alias("above")), "merkle-tops")
    found = _extract(m.trees, tops, m.fanout, m.stride, ["row"])
    return found.select("row.*", F.col("digest").alias("leaf"), "above.subroot", "above.root", "path").drop("_")


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda acc, x: digest(x["left"], acc, x["right"]))
