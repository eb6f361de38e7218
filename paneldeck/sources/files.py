"""File sources and sinks.

Reads always declare a schema (no inference) and keep broken lines in a
``_corrupt`` column instead of failing the job.  Existence checks go through
the Hadoop FileSystem of the session, so they work on HDFS / object stores,
not only on a local disk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneldeck.functions.clean import parse_text_date, says_something

CORRUPT = "_corrupt"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, date_cols: tuple[str, ...] = (),
                   keep_corrupt: bool = False, reject_col: str | None = None) -> DataFrame:
    """Typed CSV scan.  A missing path yields an empty typed frame
    (never an error); malformed lines are kept with NULL fields (PERMISSIVE)
    and, on request, their raw text in ``_corrupt``; ``date_cols`` are read as
    text and coerced leniently, in any of the common ways of writing a date (bad
    date -> NULL).  ``reject_col`` names a boolean column that is true where a date
    column said something that is no date, so that such rows can be counted."""
    if not _fs_exists(spark, path):
        extra = [T.StructField(CORRUPT, T.StringType())] * keep_corrupt
        extra += [T.StructField(reject_col, T.BooleanType())] if reject_col else []
        return empty(spark, T.StructType(schema.fields + extra))
    read_schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in date_cols else f.dataType, True)
                                for f in schema.fields] + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(read_schema).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    # The first also takes fractions of seconds and zones; a number alone is no year of five figures.
    dates = {c: F.coalesce(F.when(F.col(c).rlike(r"^\s*\d{4}(\D|$)"), F.try_to_timestamp(F.col(c))).cast("date"),
                           parse_text_date(c)) for c in date_cols}
    if reject_col:
        off = [says_something(c) & d.isNull() for c, d in dates.items()]
        df = df.withColumn(reject_col, reduce(lambda x, y: x | y, off, F.lit(False)))
    df = df.withColumns(dates) if dates else df
    return df if keep_corrupt else df.drop(CORRUPT)


def missing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    return [p for p in paths if not _fs_exists(spark, p)]


def load_strict(spark: SparkSession, specs: dict[str, tuple[str, T.StructType]]) -> dict[str, DataFrame]:
    """Load every table or raise listing all missing files."""
    miss = missing_paths(spark, [p for p, _ in specs.values()])
    if miss:
        raise FileNotFoundError(f"missing input files: {miss}")
    return {k: read_typed_csv(spark, p, s) for k, (p, s) in specs.items()}


def load_soft(spark: SparkSession, specs: dict[str, tuple[str, T.StructType]]) -> tuple[dict, DataFrame]:
    """Load what exists; also return a status table (name, path, status)."""
    status = []
    out = {}
    for k, (p, s) in specs.items():
        ok = _fs_exists(spark, p)
        status.append((k, p, "loaded" if ok else "missing"))
        if ok:
            out[k] = read_typed_csv(spark, p, s)
    return out, spark.createDataFrame(status, "name string, path string, status string")


def first_existing(spark: SparkSession, candidates: list[tuple[str, T.StructType]]) -> DataFrame | None:
    """Use whichever of several optional sources exists first."""
    for p, s in candidates:
        if _fs_exists(spark, p):
            return read_typed_csv(spark, p, s)
    return None


def read_glob(spark: SparkSession, base: str, schema: T.StructType, pattern: str = "*.csv",
              exclude_substring: str | None = None, recursive: bool = True) -> DataFrame:
    """Many files under ``base`` (recursively) matching ``pattern``, with
    provenance columns: file path, file name, parent folder (category) and the
    participant id taken from the name prefix before the first '_'."""
    if not _fs_exists(spark, base):
        return empty(spark, T.StructType(schema.fields + [T.StructField(n, T.StringType()) for n in
                                                           ("source_path", "file_name", "folder", "participant_id")]))
    df = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", recursive)
          .option("pathGlobFilter", pattern).csv(base))
    path = F.col("_metadata.file_path")
    df = df.withColumns({
        "source_path": path,
        "file_name": F.regexp_extract(path, r"([^/]+)$", 1),
        "folder": F.regexp_extract(path, r"([^/]+)/[^/]+$", 1),
    })
    df = df.withColumn("participant_id", F.split(F.col("file_name"), "_").getItem(0))
    if exclude_substring:
        df = df.filter(~F.col("file_name").contains(exclude_substring))
    return df


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add absent columns as typed NULLs, cast present ones, fixed order."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name) if dict(df.dtypes)[f.name] == "string"
                        and not isinstance(f.dataType, T.StringType) else F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def save_table(df: DataFrame, csv_path: str | None = None, parquet_path: str | None = None,
               partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """CSV (header) and/or Parquet sink, optionally partitioned (e.g. by a
    date or subject bucket column) so later reads prune partitions."""
    if csv_path:
        w = df.write.mode(mode).option("header", True)
        (w.partitionBy(*partition_by) if partition_by else w).csv(csv_path)
    if parquet_path:
        w = df.write.mode(mode)
        (w.partitionBy(*partition_by) if partition_by else w).parquet(parquet_path)


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines sink (model coefficient / fit tables)."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed JSON source."""
    if not _fs_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).json(path)
