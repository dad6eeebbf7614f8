"""A Merkle manifest of a dataset: one hash for all rows, and for each row the proof that it is among them.

Every row is a leaf, the hash of some of its columns. The leaves of each group (a language) stand in the
order of a key. While a group has several nodes, every ``FAN`` consecutive ones make up a run, and the hash of
a run is a node of the next level; what is left is the group's subroot. The subroots, ordered by group, are the
leaves of a last tree, whose root is the manifest's.

* Positions come from a range partitioning: each partition is sorted, numbered and written, and the rows
  of each group in the partitions before are added. No group goes through one task.
* Levels: a node stands in the row of its first leaf, so the nodes of level ``k`` are ``FAN ** k`` rows
  apart, and its siblings are lag and lead columns at fixed offsets, masked by the node's slot in its run and by
  the run's length. The first row of a run hashes the parent. ``LEVELS`` levels fit a window partition of
  ``FAN ** LEVELS`` rows; the nodes above them, a table that much smaller, are treated in the same way.
* Proofs: a row's path is one pair per level, the hashes of the siblings on its left and on its right. Inside a
  window partition the last pair before or at a row is its ancestor's; paths of the tables above come by a join
  on group and block, so a large group spreads over its blocks.

Only the size of the largest group and the number of groups pass the driver.

Edge cases: a null column is hashed as such and differs from an empty one. Rows with a null key come first in
their group; rows of one key stand in the order of their leaves, so repeated rows give the same hash in
any order of input, and keep a row each. Null groups are a group, the first. Texts are hashed whole. Further
columns (of any name) change nothing. An empty table has no root and gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingotflow.llm.common import written

FAN, LEVELS = 8, 3
SPAN = FAN ** LEVELS
_ROW = (1 << 33) - 1  # the row's number in its partition, in ``monotonically_increasing_id``


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: Sequence[Column]) -> Column:
    """The hash of a row's columns, each with its length in bytes in front."""
    texts = [c.cast("string") for c in columns]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                    for t in texts))


def positioned(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``pos``, their position in the group from 0, and ``n``, its number of rows.

    ``df`` should be a written table, since its rows are read twice.
    """
    keys = [group, *order, "_tie"]  # spreads rows that are equal throughout
    sorted_rows = written(
        df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("_tie").withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33)).withColumn("_no", F.col("_id").bitwiseAND(F.lit(_ROW))).drop("_id"),
        "sorted")
    parts = Window.partitionBy(group)
    before = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(
        sorted_rows.groupBy(group, "_part").agg(F.count("*").alias("_rows"), F.min("_no").alias("_first"))
        .select(group, "_part", F.sum("_rows").over(parts).alias("n"),
                (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "shifts")
    return (sorted_rows.join(shifts, [group, "_part"]).withColumn("pos", F.col("_no") + F.col("_shift"))
            .drop("_part", "_no", "_shift"))


def climbed(nodes: DataFrame) -> DataFrame:
    """Up ``LEVELS`` levels: the rows with ``block``, ``up`` (in a block's first row, the node that it becomes)
    and ``path``; ``nodes``: ``part, pos, n, hash`` and further columns."""
    window = Window.partitionBy("part", "block").orderBy("pos")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = nodes.withColumn("block", F.expr(f"pos div {SPAN}")).withColumn("up", F.col("hash"))
    levels = []
    for k in range(LEVELS):
        step = FAN ** k
        at, size = F.expr(f"pos div {step}"), F.expr(f"(n + {step - 1}) div {step}")
        slot = at % FAN
        length = F.least(F.lit(FAN), size - (at - slot))
        left = [F.when(slot >= j, F.lag("up", j * step).over(window)) for j in range(FAN - 1, 0, -1)]
        right = [F.when(slot + j < length, F.lead("up", j * step).over(window)) for j in range(1, FAN)]
        many = size > 1
        level = f"level{k}"
        rows = rows.withColumn(level, F.when((F.col("pos") % step == 0) & many, F.struct(
            F.concat_ws("", *left).alias("left"), F.concat_ws("", *right).alias("right"))))
        rows = rows.withColumn("up", F.when(F.col("pos") % (step * FAN) == 0, F.when(
            many, digest(F.col("up"), F.col(level)["right"])).otherwise(F.col("up"))))
        levels.append(level)
    inherited = F.array(*(F.last(level, ignorenulls=True).over(so_far) for level in levels))
    return rows.withColumn("path", F.filter(inherited, lambda x: x.isNotNull())).drop(*levels)


def tree_of(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, and above them tables of every ``LEVELS``-th level, down to one row per group."""
    tables, widest = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        tables.append(written(
            climbed(tables[-1]).where(F.col("pos") % SPAN == 0)
            .select("part", F.col("block").alias("pos"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"),
                    F.col("up").alias("hash")), "nodes"))
        widest = -(-widest // SPAN)
    return tables


def descended(tables: list[DataFrame], top: DataFrame) -> DataFrame:
    """The rows of the first table with ``path`` and the columns of ``top``, which has ``part``, ``path`` and
    whatever belongs to a whole group."""
    carried = [c for c in top.columns if c not in ("part", "path")]
    rows = tables[-1].join(top, "part")
    for nodes in reversed(tables[:-1]):
        above = written(rows.select("part", F.col("pos").alias("block"), F.col("path").alias("_above"), *carried),
                        "paths")
        rows = climbed(nodes).join(above, ["part", "block"]).withColumn(
            "path", F.concat("path", "_above")).drop("block", "up", "_above")
    return rows


def build(df: DataFrame, columns: Sequence[str], group: str = "lang", order: str = "doc_id",
          extra: dict[str, Column] | None = None) -> DataFrame:
    """``order``, ``leaf``, ``subroot``, ``root``, ``path`` and the columns of ``extra`` of every row.

    ``path`` holds a pair ``left, right`` of joined sibling hashes for each level from the leaf to the root.
    ``extra`` columns are computed from the row beside its leaf.
    """
    extra = extra or {}
    key = F.col(group).cast("string")
    leaves = written(df.select(
        F.coalesce(F.concat(F.lit("="), key), F.lit("")).alias("part"), F.col(order).alias("_order"),
        leaf([F.col(c) for c in columns]).alias("hash"), *(c.alias(f"_extra_{name}") for name, c in extra.items())),
        "leaves")
    groups = tree_of(written(positioned(leaves, "part", ["_order", "hash"]), "positioned"))
    subroots = written(groups[-1].select(F.lit("").alias("part"), F.col("part").alias("member"), "hash"), "subroots")
    last = tree_of(written(positioned(subroots, "part", ["member"]), "members"))
    root = last[-1].select("part", F.col("hash").alias("root"), F.array().cast(
        "array<struct<left:string,right:string>>").alias("path"))
    tops = written(descended(last, root).select(F.col("member").alias("part"), F.col("hash").alias("subroot"),
                                                "root", "path"), "tops")
    return descended(groups, tops).select(
        F.col("_order").alias(order), F.col("hash").alias("leaf"), "subroot", "root", "path",
        *(F.col(f"_extra_{name}").alias(name) for name in extra))


def siblings(path: Column) -> Column:
    """All sibling hashes of a path, joined."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), "")


def folded(path: Column, first: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, first, lambda node, level: digest(level["left"], node, level["right"]))
