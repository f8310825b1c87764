"""Rows of groups in order, spread over tasks by range, so that one huge group fills many tasks.

``in_order`` sorts all rows by group and order columns over range partitions and gives each its partition and its
place in it. Equal rows are summed up first (``copies``), since no range could part them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migrascope.llm.common import saved

PREFIX = 128  # characters of a text that part ranges; rows that agree so far stay in one partition


def in_order(rows: DataFrame, group: str, order: list[str], text: str) -> DataFrame:
    """The distinct rows with ``copies``, ``part`` and ``idx``, kept in the shared checkpoint folder.

    Sorted by group, then by ``order`` (nulls first), then by ``text``.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    ranged = counted.repartitionByRange(group, *order, F.substring(text, 1, PREFIX))
    ordered = ranged.sortWithinPartitions(group, *order, text)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return saved(ordered.select("*", F.spark_partition_id().alias("part"), place.alias("idx")))


def positions(ordered: DataFrame, group: str, copies: Column) -> DataFrame:
    """``ordered`` with ``pos``, the number of rows of the group before each, copies counted.

    Within a partition a running sum per group; what a group has in earlier partitions comes from a table of
    one row per group and partition, so a window never holds more than one partition's rows of a group.
    """
    near = Window.partitionBy(group, "part").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ordered.withColumn("local", F.sum(copies).over(near) - copies)
    parts = ordered.groupBy(group, "part").agg(F.sum(copies).alias("size"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(group, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")).filter("offset > 0")
    joined = local.join(offsets, [group, "part"], "left")
    return joined.withColumn("pos", F.col("local") + F.coalesce("offset", F.lit(0))).drop("local", "offset")
