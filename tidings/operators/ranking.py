"""Positions and top rows of a result ordered by count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import drop_staged, stage


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """First ``k`` rows in the given order; each task keeps only ``k`` rows."""
    return df.orderBy(*order).limit(k)


def rank_rows(
    df: DataFrame, *order: Column, name: str = "rn", total_of: str | None = None, stored: bool = False
) -> DataFrame:
    """Add the 1-based position of every row in ``order``, without one big sort.

    The rows are range-partitioned, sorted and written to the work folder once,
    where the place of a row in its file is its number. What is left is a running sum over
    one row per file, the only thing that is broadcast. ``order`` has to tell all
    rows apart for the positions to be the same in every run. With ``total_of``
    a column ``total`` with the sum of that column comes along.

    Dealing by range reads the rows twice, once for a sample. So they are written
    first, unless ``stored`` says that reading them again costs little.

    Runs jobs when called.
    """
    rows = df if stored else stage(df, "unranked")
    ranked = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order), "ranked")
    if not stored:
        drop_staged(rows)
    # The place of a row is that of its file and its own in there, so no column of numbers is stored.
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    sums = [F.sum(total_of).alias("_sum")] if total_of else []
    parts = ranked.groupBy(file.alias("_file")).agg(F.count("*").alias("_rows"), *sums)

    # A task writes one file, or several one after another.
    place = [F.regexp_extract("_file", pattern, 1).cast("int") for pattern in (r"^part-(\d+)-", r"-c(\d+)\.")]
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    columns = ["_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")]
    if total_of:
        everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        columns.append(F.sum("_sum").over(everything).alias("total"))
    offsets = parts.select(*columns)

    out = (
        ranked.select("*", file.alias("_file"), row.alias("_at"))
        .join(F.broadcast(offsets), "_file")
        .withColumn(name, F.col("_before") + F.col("_at") + 1)
        .drop("_file", "_at", "_before")
    )
    out.staged_path = ranked.staged_path
    return out


def rank_by_count(df: DataFrame, *keys: str, count: str = "count", name: str = "rn") -> DataFrame:
    """Positions by count, largest first; equal counts in the order of ``keys``."""
    return rank_rows(df, F.desc(count), *[F.asc(k) for k in keys], name=name)
