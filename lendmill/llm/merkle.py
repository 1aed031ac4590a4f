"""Merkle manifest of a dataset: a digest per row, a tree per group, a tree over the groups.

Nodes of a level are numbered from 0 within their group. The numbers of a node's
siblings follow from its own: its number with the last bit flipped in a binary tree,
otherwise the other slots of its run of ``arity`` nodes. Every level is joined to itself
on those numbers, which gives each node the digests before and after its own; the nodes
in slot 0 then hold a whole run and emit its parent. Groups whose tree has come to one
node leave the rounds. The groups' roots, in order of the groups, are the leaves of one
more tree. On the way down each node takes its parent's path and puts its own siblings in
front, so paths are made by one join per level.

How it runs: rows are numbered by a range partitioning on group, order column and digest
and by their place in it, so no group is ever sorted in one task, whatever its share of
the rows; rows equal in all of these are told apart by a number given when digests are
written. Texts are read once and do not travel. A level has a third of the nodes below it
(``arity`` 3), and the number of levels is the logarithm of the largest group. Two numbers
and the root reach the driver. Each level is written to the shared folder, so a lost
executor costs one task of one level.

Digests are SHA-256 over the children's digests as lower-case hexadecimal text; between
steps they are kept as 32 bytes.

Defined results: a null value has a digest of its own (``-``), an empty text another
(``0:``). A null group is a group, the first; null order values come first. Repeated rows
are leaves of their own; their paths differ, their digests do not. A lone leaf is its
group's root, and a lone group's root is the root; their paths are empty there. Very long
texts are one value each. Empty table: no rows. Columns of the input named like a
result are replaced by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm.columns import hidden, position, shown, written

ARITY = 3

#: What a missing value is written as, and what stands between a value's length and itself.
MISSING, COLON = "-", ":"


def row_digest(*columns: str | Column) -> Column:
    """Hexadecimal digest of a row: each value as ``bytes:value``, or ``-`` where it is null."""

    def said(c: str | Column) -> Column:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(value), F.lit(COLON), value), F.lit(MISSING))

    return F.sha2(F.concat(*map(said, columns)), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of its path."""
    return F.aggregate(
        path, leaf, lambda own, s: F.sha2(F.concat(_hex(s["before"]), own, _hex(s["after"])), 256)
    )


def path_digest(path: Column) -> Column:
    """Digest of all siblings on a path, from the leaf to the root, left to right."""
    siblings = F.transform(path, lambda s: F.concat(_hex(s["before"]), _hex(s["after"])))
    return F.sha2(F.array_join(siblings, ""), 256)


# ---- numbering ----------------------------------------------------------------


def _ordered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in global order: ``part`` numbers the ranges, ``place`` the rows of all ranges up
    to a gap between ranges. Written, so the numbers stay whatever is lost later."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = sorted_rows.withColumn("place", F.monotonically_increasing_id())
    return written(placed.withColumn("part", F.spark_partition_id()), "merkle-order")


def _numbered(rows: DataFrame) -> DataFrame:
    """``g``, the number of the row's group in order, ``i``, the row's in its group, and
    ``n``, the group's rows. Rows have group, sort, leaf and tag."""
    placed = _ordered(rows, "group", "sort", "leaf", "tag")
    # a row per range and group in it
    runs = placed.groupBy("part", "group").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("held")
    )
    runs = written(runs, "merkle-runs")
    totals = _ordered(runs.groupBy("group").agg(F.sum("held").alias("n")), "group")
    # a row per range, so one task adds up as many numbers as there are partitions
    ranges = totals.groupBy("part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("base", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    groups = totals.join(ranges.select("part", "first", "base"), "part").select(
        F.col("group").alias("of"), "n", (F.col("place") - F.col("first") + F.col("base")).alias("g")
    )
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    runs = runs.join(groups, F.col("group").eqNullSafe(F.col("of"))).select(
        F.col("part").alias("in_part"), "of", "first", "base", "g", "n"
    )
    same = (F.col("part") == F.col("in_part")) & F.col("group").eqNullSafe(F.col("of"))
    number = (F.col("place") - F.col("first") + F.col("base")).alias("i")
    return placed.join(runs, same).select(*rows.columns, "g", number, "n")


# ---- levels -------------------------------------------------------------------


def _run(arity: int) -> Column:
    return F.floor(F.col("i") / arity)


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (g, i, n, h) with the joined digests of their siblings ``before`` and ``after`` them."""
    i = F.col("i")
    slot = i % arity
    out, found = nodes, []
    for shift in range(1, arity):
        number = i.bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else i - slot + (slot + shift) % arity
        other = nodes.select(
            F.col("g").alias("other_g"), F.col("i").alias(f"i{shift}"), F.col("h").alias(f"h{shift}")
        )
        out = out.withColumn("sibling", number).join(
            other, (F.col("g") == F.col("other_g")) & (F.col("sibling") == F.col(f"i{shift}")), "left"
        )
        out = out.drop("other_g", "sibling")
        found.append(F.struct(F.col(f"i{shift}").alias("i"), F.col(f"h{shift}").alias("h")))
    others = F.array_sort(F.filter(F.array(*found), lambda s: s["i"].isNotNull()))

    def joined(keep) -> Column:
        return F.aggregate(
            F.filter(others, keep), F.lit(b""), lambda all_, s: F.concat(all_, s["h"])
        )

    before, after = joined(lambda s: s["i"] < i), joined(lambda s: s["i"] > i)
    return out.select("g", "i", "n", "h", before.alias("before"), after.alias("after"))


def _rounds(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels from the leaves up, and each group's root: g, h and the level it is on."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    roots: list[DataFrame] = []

    def settled() -> DataFrame:
        return nodes.where("n = 1").select("g", "h", F.lit(len(levels)).alias("level"))

    roots.append(settled())
    while most > 1:
        level = written(_with_siblings(nodes.where("n > 1"), arity), "merkle-level")
        levels.append(level)
        whole = F.sha2(F.concat(_hex(F.col("h")), _hex(F.col("after"))), 256)
        nodes = level.where(F.col("i") % arity == 0).select(
            "g", _run(arity).alias("i"), F.ceil(F.col("n") / arity).alias("n"), F.unhex(whole).alias("h")
        )
        most = -(-most // arity)
        roots.append(settled())
    return levels, written(reduce(DataFrame.union, roots), "merkle-roots")


def _step() -> Column:
    return F.array(F.struct("before", "after"))


def _paths(levels: list[DataFrame], tops: DataFrame, lowest: int, arity: int) -> DataFrame:
    """``g``, ``i``, ``top`` and ``path`` of the nodes of level ``lowest``; ``tops`` holds those
    of the groups' roots with the level they are on."""

    def settled(level: int) -> DataFrame:
        on = tops.where(F.col("level") == level)
        return on.select("g", F.lit(0).cast("long").alias("i"), "top", "path")

    paths = settled(len(levels))
    for number in reversed(range(lowest, len(levels))):
        above = paths.select(F.col("g").alias("of"), F.col("i").alias("run"), "top", "path")
        here = levels[number].join(above, (F.col("g") == F.col("of")) & (_run(arity) == F.col("run")))
        here = here.select("g", "i", "top", F.concat(_step(), "path").alias("path"))
        paths = here.union(settled(number))
    return paths


def manifest(
    rows: DataFrame,
    leaf: str = "leaf",
    group: str = "source",
    order: str = "doc_id",
    arity: int = ARITY,
) -> DataFrame:
    """The rows with ``subroot``, ``root`` (hexadecimal) and ``path`` added.

    ``leaf`` holds a row's digest (``row_digest``). ``path`` is an array, from the leaf up, of
    the joined digests ``before`` and ``after`` the own one in its run; ``fold`` takes it.
    """
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    inner = hidden(rows)
    in_group, in_order, in_leaf = (position(rows, c) for c in (group, order, leaf))
    keyed = inner.withColumns(
        {
            "group": F.col(in_group),
            "sort": F.col(in_order),
            "leaf": F.unhex(in_leaf),
            "tag": F.monotonically_increasing_id(),
        }
    )
    leaves = written(_numbered(written(keyed, "merkle-leaves")), "merkle-numbered")
    levels, roots = _rounds(leaves.select("g", "i", "n", F.col("leaf").alias("h")), arity)
    # the groups' roots are the leaves of one more tree
    n_groups = F.lit(roots.count()).alias("n")
    over, top = _rounds(
        roots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), n_groups, "h"), arity
    )
    root = top.select(_hex(F.col("h")).alias("h")).first()
    kind = "array<struct<before:binary,after:binary>>"
    end = top.select("g", "level", F.col("h").alias("top"), F.array().cast(kind).alias("path"))
    to_root = _paths(over, end, 0, arity).select(F.col("i").alias("of"), "path")
    tops = roots.join(to_root, F.col("g") == F.col("of"))
    tops = written(tops.select("g", "level", F.col("h").alias("top"), "path"), "merkle-tops")
    # leaves meet their own siblings first, then the paths above: those are a third as many
    above = _paths(levels, tops, 1, arity) if levels else tops.where("false").select(
        "g", F.lit(0).cast("long").alias("i"), "top", "path"
    )
    alone = tops.where("level = 0").select("g", F.lit(0).cast("long").alias("i"), "top", "path")
    above = above.union(alone) if levels else alone
    above = above.select(F.col("g").alias("of"), F.col("i").alias("run"), "top", "path")
    own = leaves.drop("group", "sort", "leaf", "tag")
    if levels:
        own = own.join(levels[0].select("g", "i", "before", "after"), ["g", "i"], "left")
    else:
        none = F.lit(None).cast("binary")
        own = own.withColumns({"before": none, "after": none})
    found = own.join(above, (F.col("g") == F.col("of")) & (_run(arity) == F.col("run")))
    path = F.when(F.col("before").isNotNull(), F.concat(_step(), "path")).otherwise(F.col("path"))
    found = found.withColumns(
        {
            "subroot": _hex(F.col("top")),
            "root": F.lit(root["h"] if root else None).cast("string"),
            "path": path,
        }
    )
    return shown(found, rows.columns, {c: c for c in ("subroot", "root", "path")})
