"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space that separates words, and its complement.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def whole(text) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def stripped(text: Column) -> Column:
    """Without the white space at both ends."""
    return F.trim(text, F.lit(WHITE_CHARS))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Array of the words of a non-null text (empty array without words)."""
    body = stripped(text)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WHITE + "+"))


def word_count(text: Column) -> Column:
    """Number of words as long, 0 for an empty text."""
    body = stripped(text)
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, WHITE + "+"))).cast("long")


def key128(value: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; together the 128-bit key of a string."""
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)



def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Send Python workers texts in batches of at most ``size``: what a worker
    holds is then bounded however long the documents are.  Set on the session,
    as the plans are made when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others give memory back by themselves


def give_back() -> None:
    """Return the freed memory of a Python worker to the machine.  Workers are kept
    from stage to stage, and what a batch's arrays took would stay with them."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
