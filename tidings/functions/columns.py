"""What the expression modules share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
