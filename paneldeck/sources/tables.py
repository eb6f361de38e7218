"""Parquet table access.  Column pruning and filter pushdown are left to
Catalyst: callers select the columns they need right after the read.  How many
splits a scan has is the submitter's choice (``spark.sql.files.*``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from paneldeck.session import input_listing

# Rows of dictionary-coded columns take at least so many times their stored size in memory.
STORED_RATIO = 8
BROADCAST_BYTES = "spark.sql.autoBroadcastJoinThreshold"

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def join_side(df: DataFrame, sf_dir: str, name: str) -> DataFrame:
    """``df``, columns of the table ``name``, as the side of a join.  The planner goes by
    the file's size, and would send a well compressed table of millions of rows whole
    through the driver to every executor: such a one is to be shuffled."""
    spark = df.sparkSession
    limit = spark.conf.get(BROADCAST_BYTES)
    if limit.startswith("-"):  # nothing is broadcast
        return df
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    stored = sum(length for _, length, _ in input_listing(spark, table_path(sf_dir, name)))
    return df.hint("merge") if most < stored * STORED_RATIO else df
