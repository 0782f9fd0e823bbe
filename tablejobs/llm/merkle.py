"""Merkle trees over a dataset by slot pivots.

A level of a tree is made by one grouping: conditional aggregates spread the children of each parent into FANOUT slot
columns, and the hash of the columns put together is the parent. Going down, the slot columns around a child's own, left and
right of it, are its siblings. So every level is one map-side reduced grouping up and one join of parents down, a parent's
children come out of its row without a join of their own, and all of it runs on Spark's built-in expressions.

Nodes of a group (a language, and then all subroots) are numbered by one range shuffle of the leaves, not by a window: the
ranges split a group of any size, and the place in a range plus the rows of earlier ranges is the place in the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.links import kept

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, a colon, and the value's text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """`rows` with `pos`, the place (from 0) in their group by `order`, NULLs first, and `count`, the group's rows.

    Rows that agree on all of this may lie in several ranges; which of them comes first makes no difference to a tree.
    """
    spark = rows.sparkSession
    salted = rows.withColumn("__salt", F.monotonically_increasing_id() % 1024)
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "__salt")]
    ranged = salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("__salt")
    # The id holds the range above bit 33 and the place in the range below.
    ranged = kept(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    before, seen = [], 0
    for r in sizes:
        before.append((r["__part"], seen))
        seen += r.n
    # One row for each range, however many rows there are.
    before = F.broadcast(spark.createDataFrame(before, "__part long, __before long"))
    place = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1)
    placed = ranged.withColumn("__part", part).join(before, "__part").withColumn("pos", place).drop("__part", "__before", "__at")
    starts = placed.groupBy(F.col(group).alias("__group")).agg(F.min("pos").alias("__start"), F.count(F.lit(1)).alias("count"))
    starts = kept(starts, "groups")
    return (
        placed.join(starts, F.col(group).eqNullSafe(F.col("__group")))
        .withColumn("pos", F.col("pos") - F.col("__start"))
        .drop("__group", "__start")
    )


def _parents(nodes: DataFrame) -> DataFrame:
    """(group, count, pos, s0 .. s7): the nodes of groups that have several, spread into the slots of their parents."""
    slot = F.col("pos") % FANOUT
    columns = [F.max(F.when(slot == i, F.col("node"))).alias(f"s{i}") for i in range(FANOUT)]
    parents = nodes.filter("count > 1").groupBy("group", "count", F.floor(F.col("pos") / FANOUT).alias("pos")).agg(*columns)
    return parents.withColumn("count", F.ceil(F.col("count") / FANOUT))


def _hash(i: int) -> Column:
    return F.col(f"s{i}.hash")


def _hashed(parents: DataFrame) -> DataFrame:
    """The parents as nodes of the next level."""
    together = F.sha2(F.concat_ws("", *[_hash(i) for i in range(FANOUT)]), 256)
    return parents.select("group", "count", "pos", F.struct(together.alias("hash")).alias("node"))


def _children(parents: DataFrame) -> DataFrame:
    """(group, pos, node, path): each child with its siblings in front of its parent's path."""
    slots = []
    for i in range(FANOUT):
        step = F.struct(
            F.concat_ws("", *[_hash(j) for j in range(i)]).alias("left"),
            F.concat_ws("", *[_hash(j) for j in range(i + 1, FANOUT)]).alias("right"),
        )
        slots.append(
            F.struct(
                (F.col("pos") * FANOUT + i).alias("pos"), F.col(f"s{i}").alias("node"), F.concat(F.array(step), F.col("path")).alias("path")
            )
        )
    return parents.select("group", F.inline(F.array(*slots))).filter("node is not null")


class Forest:
    """One tree for each group of `nodes`: (group, count, pos, node), where a node is a struct that has its `hash`."""

    def __init__(self, nodes: DataFrame) -> None:
        self.nodes = nodes
        self.levels: list[DataFrame] = []
        largest, level = nodes.agg(F.max("count")).first()[0] or 0, nodes
        self.singles = [nodes.filter("count = 1")]
        while largest > 1:
            parents = kept(_parents(level), f"parents-{len(self.levels)}")
            self.levels.append(parents)
            level = _hashed(parents)
            self.singles.append(level.filter("count = 1"))
            largest = -(-largest // FANOUT)

    def roots(self) -> DataFrame:
        """(group, hash)"""
        found = [s.select("group", F.col("node.hash").alias("hash")) for s in self.singles]
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        return out

    def leaves(self, above: DataFrame) -> DataFrame:
        """(group, node, path) of every leaf; `above` has (group, path): the path of each group's root."""
        paths = None
        for depth in range(len(self.levels), -1, -1):
            ends = _same_group(self.singles[depth].select("group", "pos", "node"), above)
            if depth < len(self.levels):
                inner = self.levels[depth].drop("count").withColumnsRenamed({"group": "__group", "pos": "__pos"})
                up = paths.select("group", F.col("pos").alias("parent"), "path")
                on = F.col("__group").eqNullSafe(F.col("group")) & (F.col("__pos") == F.col("parent"))
                joined = inner.join(up, on).select("group", F.col("__pos").alias("pos"), "path", *[f"s{i}" for i in range(FANOUT)])
                below = _children(joined)
                ends = below.unionByName(ends)
            paths = ends if depth == 0 else kept(ends.drop("node"), f"paths-{depth}")
        return paths.select("group", "node", "path")


def _same_group(left: DataFrame, right: DataFrame) -> DataFrame:
    named = right.withColumnRenamed("group", "__group")
    return left.join(named, F.col("group").eqNullSafe(F.col("__group"))).drop("__group")


def proof(path: Column) -> Column:
    """All siblings, level by level from the leaf, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(
    docs: DataFrame, id: str = "doc_id", group: str = "lang", columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), tampered: Column | None = None, altered: str = "text"
) -> DataFrame:
    """(id, leaf, subroot, root, path, held, folded_root): a hash of each row, a tree for each group, a tree of the groups' roots.

    A leaf is the hash of `columns`, NULLs told from texts; leaves of a group ascend by `id` (NULL first, then by the leaf).
    `path` has the siblings left and right of the leaf's ancestors up to the root. Where `tampered` is true, `held` is the leaf
    of the row with A-Z of `altered` in lower case, else the leaf itself; `folded_root` is the root that `held` and the path
    give. NULL is a group, before all others. Rows of a repeated id are leaves each; a lone row is its own root; an empty
    table has no rows.
    """
    own = [F.col(f"`{c}`") for c in columns]
    changed = [F.translate(F.col(f"`{c}`"), UPPER, LOWER) if c == altered else F.col(f"`{c}`") for c in columns]
    leaf = leaf_hash(own)
    held = F.when(tampered, leaf_hash(changed)).otherwise(leaf) if tampered is not None else leaf
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{group}`").cast("string").alias("group"), leaf.alias("hash"), held.alias("held")
    )
    nodes = numbered(kept(rows, "leaves"), "group", ["id", "hash"])
    nodes = nodes.select("group", "count", "pos", F.struct("hash", "id", "held").alias("node"))
    trees = Forest(nodes)
    subroots = kept(trees.roots(), "subroots")
    tops = numbered(subroots.select(F.lit(True).alias("whole"), "group", "hash"), "whole", ["group"])
    top = Forest(tops.select(F.col("whole").alias("group"), "count", "pos", F.struct("hash", F.col("group").alias("own")).alias("node")))
    root = top.roots().first()
    start = top.singles[0].sparkSession.createDataFrame([(True, [])], "group boolean, path array<struct<left: string, right: string>>")
    above = kept(top.leaves(start).select(F.col("node.own").alias("group"), F.col("node.hash").alias("subroot"), "path"), "above")
    found = _same_group(trees.leaves(above.select("group", "path")), above.select("group", "subroot"))
    return found.select(
        F.col("node.id").alias(id),
        F.col("node.hash").alias("leaf"),
        "subroot",
        F.lit(root.hash if root else None).cast("string").alias("root"),
        "path",
        F.col("node.held").alias("held"),
        folded(F.col("node.held"), F.col("path")).alias("folded_root"),
    )
