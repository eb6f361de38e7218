"""Session windows over a stream of files, with late rows counted and kept.

A session is a run of a user's events with no pause longer than ``gap``.  Each
micro-batch moves a horizon: the latest time seen in the batches before it, less
the lateness allowed.  Events before the horizon go to a table of late rows.  The
others are merged with the open sessions; a session that no event on time can
still extend is closed, written and leaves the state.  So the state holds open
sessions only, and does not grow with the table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneldeck.session import checkpoint_dir
from paneldeck.streaming.daily_stream import EVENT_SCHEMA

SESSION = "user_id long, start timestamp, stop timestamp, n_events long, total double"
LATE = "event_id long, user_id long, ts timestamp, value double"


def merge_runs(pieces: DataFrame, gap: int, segment: int) -> DataFrame:
    """Pieces (user_id, start, stop, n_events, total) that follow each other within
    ``gap`` seconds as one.  First within (user, segment of time), then what is
    left of each user, so no raw rows of a whole user are ordered in one task."""
    def merged(rows: DataFrame, keys: list[str]) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("start", "stop")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        pause = F.unix_micros("start") - F.unix_micros(F.max("stop").over(before))
        first = F.when(pause.isNull() | (pause > gap * 1_000_000), 1).otherwise(0)
        run = F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (rows.withColumn("first", first).withColumn("run", run).groupBy(*keys, "run")
                .agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                     F.sum("n_events").cast("long").alias("n_events"), F.sum("total").alias("total")).drop("run"))

    part = F.floor(F.unix_micros("start") / (segment * 1_000_000))
    inner = merged(pieces.withColumn("part", part), ["user_id", "part"]).drop("part")
    return merged(inner, ["user_id"])


def run_sessions(spark: SparkSession, source_dir: str, sink_dir: str, name: str = "sessions", gap: int = 1800,
                 lateness: int = 3600, segment: int = 86_400):
    """Process every event file that is new in ``source_dir`` (availableNow).  Each
    batch writes folders of its own below ``sink_dir``: ``closed``, ``late``,
    ``open`` (the whole state after it) and ``horizon`` (one row), so a batch run
    again after a failure replaces what it wrote.  Events without a user or a time
    are late rows too.  Returns the finished query."""
    def folder(kind: str, number: int) -> str:
        return f"{sink_dir}/{kind}/batch={number}"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        latest = None if number == 0 else session.read.schema("latest timestamp").parquet(folder("horizon", number - 1)).first()["latest"]
        events = batch.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
        now = events.agg(F.max("ts").alias("latest")).select(F.greatest("latest", F.lit(latest).cast("timestamp")).alias("latest"))
        now.write.mode("overwrite").parquet(folder("horizon", number))
        moved = session.read.schema("latest timestamp").parquet(folder("horizon", number)).first()["latest"]
        known = F.col("ts").isNotNull() & F.col("user_id").isNotNull()
        on_time = known if latest is None else known & (F.unix_micros("ts") >= F.unix_micros(F.lit(latest)) - lateness * 1_000_000)
        events.where(~on_time).write.mode("overwrite").parquet(folder("late", number))
        pieces = events.where(on_time).select("user_id", F.col("ts").alias("start"), F.col("ts").alias("stop"),
                                              F.lit(1).cast("long").alias("n_events"), F.col("value").alias("total"))
        if number:
            pieces = pieces.unionByName(session.read.schema(SESSION).parquet(folder("open", number - 1)))
        runs = merge_runs(pieces, gap, segment)
        done = F.lit(False) if moved is None else (
            F.unix_micros("stop") + gap * 1_000_000 < F.unix_micros(F.lit(moved)) - lateness * 1_000_000)
        runs.withColumn("done", done).write.mode("overwrite").parquet(folder("runs", number))
        runs = session.read.schema(SESSION + ", done boolean").parquet(folder("runs", number))
        runs.where("done").drop("done").write.mode("overwrite").parquet(folder("closed", number))
        runs.where("not done").drop("done").write.mode("overwrite").parquet(folder("open", number))

    stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 64).parquet(source_dir)
    q = (stream.writeStream.foreachBatch(write)
         .option("checkpointLocation", os.path.join(checkpoint_dir(spark), "streams", name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_sessions(spark: SparkSession, sink_dir: str, last_batch: int) -> DataFrame:
    """All sessions: the closed ones and those still open after ``last_batch``."""
    closed = spark.read.schema(SESSION + ", batch int").parquet(f"{sink_dir}/closed").where(F.col("batch") <= last_batch)
    return closed.drop("batch").unionByName(spark.read.schema(SESSION).parquet(f"{sink_dir}/open/batch={last_batch}"))


def late_rows(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The rows that came too late, with the batch that brought them."""
    return spark.read.schema(LATE + ", batch int").parquet(f"{sink_dir}/late")
