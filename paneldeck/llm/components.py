"""Connected components of links by alternating large and small stars.

Every round is two aggregates and two joins over the links; nothing but a count
and a checksum reaches the driver, and each round's links are written, so a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneldeck.session import write_stage


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    inner = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return inner.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """v, label: the smallest vertex of its component for every vertex of ``links``
    (a, b) but that smallest one.  Loops and repeated links do no harm."""
    at = write_stage(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while (mark := _mark(at)) != before:
        before = mark
        large = write_stage(_large_star(at).distinct(), "links-large")
        at = write_stage(_small_star(large).distinct(), "links-small")
    return at.select(F.col("a").alias("v"), F.col("b").alias("label"))
