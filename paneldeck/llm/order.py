"""Positions in a global order, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneldeck.session import write_stage

# monotonically_increasing_id keeps the partition above this many bits.
PART_BITS = 33


def in_order(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``df`` sorted over all partitions and written, with ``at``, a number that
    ascends in that order.  Keys that no two rows share spread any group."""
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return write_stage(ranged.withColumn("at", F.monotonically_increasing_id()), name)


def numbered(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` of ``in_order`` (sorted by ``group`` first) with ``j``, the position
    in the group from 0 on, and ``n``, the size of the group.  Each partition
    gives one count for each group that it holds; only those are summed up."""
    part = F.shiftright("at", PART_BITS).alias("part")
    blocks = rows.groupBy(group, part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    upto = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        group, "part", (F.coalesce(F.sum("held").over(upto), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(Window.partitionBy(group)).alias("n"))
    return (rows.withColumn("part", part).join(blocks, [group, "part"])
            .withColumn("j", F.col("at") + F.col("shift")).drop("part", "shift", "at"))
