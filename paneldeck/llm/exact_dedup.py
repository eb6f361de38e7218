"""Exact dedup against a persistent digest index.

The index is a table of (digest, keep_id), bucketed and sorted by digest.  A
batch of new rows is reduced to its distinct digests (map-side partial
aggregation, so a digest that holds a third of the rows is one row per task),
sort-merge anti-joined with the index, and what is new is appended in the same
bucketing: the index side is neither shuffled nor held in memory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.llm.text import WHITE, whole
from paneldeck.session import stage_path, write_stage


def text_digest(text: str = "text") -> Column:
    """SHA-256 (32 bytes) of the text with each run of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(whole(text), WHITE + "+", " "), 256))


class DigestIndex:
    """Persistent index of the digests seen so far.

    ``path`` is a shared folder; opened again with the same bucket count, the
    index goes on where it stopped.  Without a path a new folder below
    ``spark.checkpoint.dir`` is used.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None,
                 reopen: bool = False):
        self.spark = spark
        self.path = path or stage_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"digest_index_{uuid.uuid4().hex}"
        if reopen:
            spark.sql(
                f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self.path}'")
        else:
            self._append(spark.createDataFrame([], "digest binary, keep_id long"))

    def _append(self, rows: DataFrame) -> None:
        (rows.select("digest", "keep_id").repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` (digest, id) that the index lacks;
        the smallest id of each stays (null ids come last)."""
        firsts = batch.groupBy("digest").agg(F.min("id").alias("keep_id"))
        new = firsts.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")
        self._append(write_stage(new, "digest-new"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                index: DigestIndex | None = None, batches: int = 2) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    ``docs`` passes the index in ``batches`` ranges of ascending id, so the row
    with the smallest id of equal texts stays, or the id that an index brought
    along holds already.  ``group_size`` counts the rows of ``docs``.

    Null or empty text: the empty text, equal to its like.  Null ids sort after
    all others.  Rows repeated with the same id and text give one row each, of
    which one is kept at most.  An empty table gives an empty result; other
    columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark)
    old = write_stage(index.rows(), "digest-old") if index.rows().take(1) else None
    rows = write_stage(
        docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("digest")),
        "digests")
    cuts = rows.approxQuantile("id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    low = None
    for high in sorted(set(cuts)) + [None]:
        part = rows
        if low is not None:
            part = part.where((F.col("id") > int(low)) | F.col("id").isNull())
        if high is not None:
            part = part.where(F.col("id") <= int(high))
        index.add(part)
        low = high if high is not None else low

    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    keep = spark.read.schema("digest binary, keep_id long").parquet(index.path)
    groups = sizes.join(keep, "digest")
    if old is not None:
        groups = groups.join(old.select("digest", F.lit(True).alias("known")), "digest", "left")
    else:
        groups = groups.withColumn("known", F.lit(None).cast("boolean"))
    groups = write_stage(groups, "digest-groups")
    copies = rows.groupBy("digest", "id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    joined = write_stage(copies, "digest-copies").join(groups, "digest")
    copy_no = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy_no")
    return (joined.select("*", copy_no)
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("known").isNull() & (F.col("copy_no") == 1)
                     & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
