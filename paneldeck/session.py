"""Session construction and cluster-safe settings.

The library never hard-codes cluster paths: the checkpoint folder is read from
``spark.checkpoint.dir`` of the running session and only set when it is unset
(tests, local runs).
"""

from __future__ import annotations

import math
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every paneldeck job relies on.
#  * AQE re-plans joins (broadcast vs sort-merge) from runtime sizes, splits
#    skewed join partitions and coalesces small shuffle partitions.
#  * requireAllClusterKeysForCoPartition=false lets joins on (subject, week)
#    reuse a hash(subject) partitioning produced upstream (one exchange per
#    input branch instead of two).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Runtime SQL settings the query plans rely on (safe to set on any session;
# partition counts and cluster paths stay with the submitter).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


# Input bytes (as stored) for each shuffle partition that a plan starts with, and
# shuffle bytes up to which the adaptive planner merges partitions again.  A task
# sorts several columns of its partition at once, at about 25 times these bytes.
PARTITION_BYTES = 16 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def apply_plan_conf(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Settings of the plans.  With an input ``folder``, the number of partitions
    that shuffles start with follows its size, so that a task's share of the rows
    does not grow with the input; the submitter's own count is the least."""
    conf = dict(PLAN_CONF)
    if folder is not None:
        size = sum(length for _, length, _ in input_listing(spark, folder))
        counts = [spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(INITIAL_PARTITIONS, None) or 1]
        conf[INITIAL_PARTITIONS] = str(max(math.ceil(2 * size / PARTITION_BYTES), *map(int, counts)))
        own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY_BYTES, "64m"))
        conf[ADVISORY_BYTES] = f"{min(own, PARTITION_BYTES)}b"
    for k, v in conf.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static or restricted conf
            pass
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all cores of the session: for heavy work on a
    narrow table that comes in few splits."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "paneldeck", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the paneldeck settings.

    On a cluster pass ``master=None`` and leave the partition count to the
    submitter; locally the shuffle partition count defaults to the core count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("PANELDECK_DRIVER_MEMORY", "8g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith("spark.driver") and not k.startswith("spark.ui"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir``; only when it is unset (local runs, tests)
    a fresh scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return d or ""
    if not d:
        d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="paneldeck-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder for one stage table below the shared checkpoint folder."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/paneldeck-stages/{app}/{name}-{uuid.uuid4().hex}"


def bucket_count(spark: SparkSession, folder: str) -> int:
    """Buckets of a stage table that is kept by key: one for each 2 MB of stored
    input, as cells are many times as wide as what they come from."""
    size = sum(length for _, length, _ in input_listing(spark, folder))
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(8 * size / PARTITION_BYTES))


def write_stage(df: DataFrame, name: str, by: list[str] | None = None, buckets: int = 0) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the
    lineage is cut, lost executors cost nothing, and later reads prune columns
    and push filters.  With ``by`` the table is kept in ``buckets`` by these
    columns, so that later groupings and joins by them need no shuffle."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    if by:
        table = f"paneldeck_{name}_{uuid.uuid4().hex}"
        df.write.format("parquet").option("path", path).bucketBy(buckets, *by).saveAsTable(table)
        return spark.table(table)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a written stage table."""
    return write_stage(df, "cut")


_MATERIALIZED: dict[tuple, tuple[tuple, DataFrame]] = {}


# Seconds that the last build of each stage took, the stages it needed included.
STAGE_SECONDS: dict[str, float] = {}


def input_listing(spark: SparkSession, folder: str) -> tuple:
    """(path, length, modification time) of every file below an input folder, as
    Spark's own file system sees them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return ()
    found, files = [], fs.listFiles(path, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def materialized(spark: SparkSession, key: tuple, build, by: list[str] | None = None) -> DataFrame:
    """A stage table written once to the shared folder and shared by every later
    query of the session over the same inputs (the role a persisted intermediate
    table plays in a production pipeline).  ``build`` returns the DataFrame to
    write.  ``key`` is (name, input folder, ...): the stage is built anew when the
    folder's files have changed, and the old one is forgotten.  ``by``: the columns
    by which it is kept in buckets."""
    name, folder, *rest = key
    k = (spark.sparkContext.applicationId, checkpoint_dir(spark), name, folder, *rest)
    listing = input_listing(spark, folder)
    known = _MATERIALIZED.get(k)
    if known is None or known[0] != listing:
        began = time.time()
        known = _MATERIALIZED[k] = (listing, write_stage(build(), name, by, bucket_count(spark, folder) if by else 0))
        STAGE_SECONDS[name] = round(time.time() - began, 3)
    return known[1]


def forget_stages() -> None:
    """Let later queries build their stage tables anew."""
    _MATERIALIZED.clear()
