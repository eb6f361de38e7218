"""What changed between two deliveries of a table, repeated rows counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counted(old: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows with ``n_old`` and ``n_new``, how often each delivery holds
    them.  Nulls equal nulls.  One aggregate over both, combined on the map side,
    so a row that is a third of a table costs one record for each task."""
    a = old.select("*", F.lit(1).alias("n_old"), F.lit(0).alias("n_new"))
    b = new.select(*old.columns, F.lit(0).alias("n_old"), F.lit(1).alias("n_new"))
    return a.unionByName(b).groupBy(*old.columns).agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))


def except_all(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``old`` as often as it holds them more often than ``new``."""
    more = F.col("n_old") - F.col("n_new")
    return counted(old, new).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), more.cast("int")))).select(*old.columns)


def intersect_all(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows as often as both deliveries hold them."""
    both = F.least("n_old", "n_new")
    return counted(old, new).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), both.cast("int")))).select(*old.columns)


def change_classes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_old, n_new, change for every key of either delivery: ``added``,
    ``removed``, ``same`` (the same rows equally often), ``repeated`` (the same
    rows, not equally often) or ``changed``.

    Each side is reduced to one digest of its distinct rows for a key and one of
    its rows with their numbers; both merge in any order.  Null keys are a key.
    """
    rows = counted(old, new)
    rest = [c for c in old.columns if c not in keys]
    one = F.xxhash64(*[F.struct(F.col(c)) for c in rest]) if rest else F.lit(0).cast("long")
    two = F.xxhash64(F.lit("second"), *[F.struct(F.col(c)) for c in rest])
    held = lambda n: F.sum(F.col(n)).alias(n)
    digest = lambda n, h: F.bit_xor(F.when(F.col(n) > 0, h))
    by_key = rows.groupBy(*keys).agg(
        held("n_old"), held("n_new"),
        F.struct(digest("n_old", one), digest("n_old", two)).alias("a"), F.struct(digest("n_new", one), digest("n_new", two)).alias("b"),
        F.count_if(F.col("n_old") != F.col("n_new")).alias("uneven"))
    same = F.hash("a").eqNullSafe(F.hash("b")) & F.to_json("a").eqNullSafe(F.to_json("b"))
    change = (F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "removed")
              .when(F.col("uneven") == 0, "same").when(same, "repeated").otherwise("changed"))
    return by_key.select(*keys, "n_old", "n_new", change.alias("change"))
