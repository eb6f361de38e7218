"""Result hygiene shared by the Spark queries and their SQL oracles:
doubles rounded to a fixed scale (+0.0 folds -0.0), counts as BIGINT."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finalize(df: DataFrame, scales: dict[str, int] | None = None, default: int = 6,
             order: list[str] | None = None) -> DataFrame:
    scales = scales or {}
    cols = []
    for name, typ in df.dtypes:
        c = F.col(name)
        if typ in ("double", "float"):
            c = (F.round(c.cast("double"), scales.get(name, default)) + F.lit(0.0)).alias(name)
        cols.append(c)
    out = df.select(*cols)
    if order:
        out = out.select(*order)
    return out
