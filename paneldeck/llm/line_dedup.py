"""Line dedup with levelled sorted runs.

The store keeps runs of (h1, h2, n_docs, holder): the 128-bit key of a line,
how many documents of the run hold it, and the largest id among them where the
run was the first to hold it.  A run is a table bucketed and sorted by the key.
Each batch is merge-anti-joined with the runs to find its new keys, then adds
a run of its own at level 0; when a level has ``fanout`` runs they are merged
into one run of the next level.  Batches come in descending order of id, so
the batch that brings a key first also has its holder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneldeck.llm.text import ascii_lower, fresh, key128, stripped, whole
from paneldeck.session import stage_path, write_stage

RUN_SCHEMA = "h1 long, h2 long, n_docs long, holder long"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(stripped(line))


def document_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """id, text_hash, pos, h1, h2: every line with a long key."""
    lines = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(whole(text_col)).alias("text_hash"),
                         F.posexplode(F.split(whole(text_col), "\n", -1)).alias("pos", "line"))
             .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars))
    h1, h2 = key128(F.col("key"))
    return lines.select("id", "text_hash", "pos", h1.alias("h1"), h2.alias("h2"))


class LineRuns:
    """The levelled runs, in a shared folder of their own."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 3):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.levels: list[list[tuple[str, str]]] = []

    def runs(self) -> list[tuple[str, str]]:
        """(table, path) of every run."""
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", stage_path(self.spark, "line-run")
        (rows.select("h1", "h2", "n_docs", "holder").repartition(self.buckets, "h1", "h2")
         .write.format("parquet").option("path", path)
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name))
        return name, path

    def _merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        # one plain scan of all folders: Spark 4.1 takes a union of bucketed
        # scans for partitioned by key and then leaves out the exchange
        return (self.spark.read.schema(RUN_SCHEMA).parquet(*[path for _, path in runs])
                .groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder")))

    def _place(self, run: tuple[str, str], level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(full))
            for name, _ in full:
                self.spark.sql(f"DROP TABLE {name}")
            self._place(merged, level + 1)

    def add(self, batch: DataFrame) -> None:
        """Add the keys of a batch (id, h1, h2; a key once for each document)."""
        own = write_stage(
            batch.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("largest")),
            "line-batch")
        new = own
        for name, _ in self.runs():
            new = new.hint("merge").join(self.spark.table(name).select("h1", "h2"), ["h1", "h2"], "left_anti")
        new = write_stage(new.select("h1", "h2", F.lit(True).alias("new")), "line-new")
        held = F.when(F.col("new"), F.col("largest"))
        self._place(self._write(own.join(new, ["h1", "h2"], "left").withColumn("holder", held)), 0)

    def repeated(self, min_docs: int) -> DataFrame:
        """h1, h2, holder of the keys that ``min_docs`` documents or more hold."""
        if not self.runs():
            return self.spark.createDataFrame([], RUN_SCHEMA).select("h1", "h2", "holder")
        return self._merged(self.runs()).where(F.col("n_docs") >= min_docs).select("h1", "h2", "holder")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                  min_docs: int = 3, batches: int = 4, runs: LineRuns | None = None) -> DataFrame:
    """id, text_hash, gone: the positions of the lines that each document loses
    (documents that lose none are absent)."""
    spark = docs.sparkSession
    runs = runs or LineRuns(spark)
    lines = write_stage(document_lines(docs, id_col, text_col, min_chars), "lines")
    held = write_stage(lines.select("id", "h1", "h2").distinct(), "line-holders")
    cuts = held.approxQuantile("id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    high = None
    for low in sorted(set(cuts), reverse=True) + [None]:
        part = held
        if low is not None:
            part = part.where(F.col("id") > int(low))
        if high is not None:
            within = F.col("id") <= int(high)
            part = part.where(within if low is not None else within | F.col("id").isNull())
        runs.add(part)
        high = low if low is not None else high
    repeated = write_stage(runs.repeated(min_docs), "line-repeated")
    return (lines.join(repeated, ["h1", "h2"])
            .where(~F.col("id").eqNullSafe(F.col("holder")))
            .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3, batches: int = 4, runs: LineRuns | None = None) -> DataFrame:
    """``docs`` with lines that other documents repeat taken out of the text,
    plus n_lines (before) and n_dropped.

    Keys of ``min_chars`` code points or more that ``min_docs`` documents or
    more hold lose all their lines except in the document with the largest id.
    Lines stay in order, joined by a line feed.

    Null text reads as one empty line and stays null if nothing is dropped from
    it (nothing can be).  Null ids are one document below all others.  Rows that
    repeat an id are one document: a key counts once, and if that document is
    its holder each of the rows keeps it.  An empty table gives an empty result.
    Columns of ``docs`` named n_lines or n_dropped are replaced.
    """
    gone = write_stage(dropped_lines(docs, id_col, text_col, min_chars, min_docs, batches, runs), "line-gone")
    gone_id, gone_hash, gone_at, lines = fresh(docs, "_gone_id", "_gone_hash", "_gone", "_lines")
    gone = gone.select(F.col("id").alias(gone_id), F.col("text_hash").alias(gone_hash), F.col("gone").alias(gone_at))
    rest = docs.drop("n_lines", "n_dropped")
    joined = rest.join(
        gone, F.col(id_col).cast("long").eqNullSafe(F.col(gone_id))
        & (F.xxhash64(whole(text_col)) == F.col(gone_hash)), "left")
    split = joined.withColumn(lines, F.split(whole(text_col), "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone_at))
    kept = F.array_join(F.transform(F.sort_array(stay), lambda i: F.get(F.col(lines), i)), "\n")
    n_dropped = F.size(lines) - F.size(stay)
    return (split.select(
        *[F.when(F.col(gone_at).isNull(), F.col(text_col)).otherwise(kept).alias(c) if c == text_col else F.col(c)
          for c in rest.columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col(gone_at).isNull(), F.lit(0)).otherwise(n_dropped).cast("long").alias("n_dropped")))
