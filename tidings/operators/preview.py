"""A few rows shown with columns as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """The first ``n`` rows by ``key``, transposed: one row per column, as text.

    ``n`` becomes the number of columns, so it has to stay small.
    """
    rows = df.orderBy(key).limit(n)
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return text.transpose(key).withColumnRenamed("key", "column")
