"""Projections and filters on the record table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns the analysis works on.
MASTER_COLUMNS = [
    "GKGRECORDID", "DATE", "AllNames", "Persons", "Organizations", "Themes", "Locations",
]


def master_view(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The analysis columns, with the date as text; ``limit`` is for a quick look only."""
    columns = [F.col(c).cast("string").alias(c) if c == "DATE" else c for c in MASTER_COLUMNS]
    master = df.select(*columns)
    return master if limit is None else master.limit(limit)


def multi_entity(df: DataFrame, col: str = "AllNames", *keep: str) -> DataFrame:
    """Records whose list in ``col`` has several items, that column and those to ``keep`` only."""
    return df.where(F.col(col).contains(";")).select(*keep, col)


def day_number(day: date | int | str) -> int:
    """A day as the number ``yyyyMMdd``."""
    return int(day.strftime("%Y%m%d") if isinstance(day, date) else day)


def on_day(df: DataFrame, day: date | int | str | None = None, col: str = "ds") -> DataFrame:
    """Records of one day by the partition column ``yyyyMMdd``; today by default."""
    if day is None:
        wanted = F.date_format(F.current_date(), "yyyyMMdd").cast("int")
    else:
        wanted = F.lit(day_number(day))
    return df.where(F.col(col) == wanted)
