"""Attributes that hold for a time, attached to records of that time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spans a range of record times is cut into; an interval is copied to at most as many.
SPANS = 64


def _span(value: Column, low, width) -> Column:
    return F.floor((value.cast("double") - F.lit(low)) / F.lit(width)).cast("int")


def with_attributes(
    records: DataFrame,
    attributes: DataFrame,
    key: str,
    time: str,
    columns: list[str],
    valid_from: str = "valid_from",
    valid_until: str = "valid_until",
    spans: int = SPANS,
) -> DataFrame:
    """Every record once, with the ``columns`` of the attribute row of its key that holds at its time.

    A row holds from ``valid_from`` up to, not including, ``valid_until``; without an end it holds
    for good, without a start it always has. Of rows that hold at once the one that began last
    counts, then the one that ends last, then the greatest by the columns. A record without such a
    row, without key or without time has nulls. ``time``, ``valid_from`` and ``valid_until`` are
    numbers or timestamps of one kind.

    The times of the records are cut into ``spans`` of equal length, and the rows of a key are
    gathered in a list for every span they reach into. So each record meets one list at most and is
    never multiplied, the records of a frequent key are joined span by span, and Spark broadcasts
    the lists where they are small. Runs a job, for the range of the times.
    """
    range_of = records.agg(F.min(time), F.max(time)).select(
        *(F.col(f"{f}({time})").cast("double").alias(f) for f in ("min", "max"))).first()
    low, high = range_of["min"] or 0.0, range_of["max"] or 0.0
    width = (high - low) / spans or 1.0
    start = F.coalesce(F.col(valid_from).cast("double"), F.lit(low))
    end = F.coalesce(F.col(valid_until).cast("double"), F.lit(high))
    reached = attributes.where(F.col(key).isNotNull() & (start <= high) & (end >= low))
    first, last = (_span(F.least(F.greatest(x, F.lit(low)), F.lit(high)), low, width) for x in (start, end))
    held = F.struct(
        F.col(valid_from).alias("_from"), F.col(valid_until).isNull().alias("_open"),
        F.col(valid_until).alias("_until"), *columns)
    lists = (
        reached.select(F.col(key).alias("_key"), held.alias("_row"), F.explode(F.sequence(first, last)).alias("_span"))
        .groupBy("_key", "_span").agg(F.sort_array(F.collect_list("_row"), asc=False).alias("_rows"))
    )
    at = F.col(time)
    marked = records.withColumn("_span", _span(at, low, width))
    joined = marked.join(lists, (F.col(key) == F.col("_key")) & (marked["_span"] == lists["_span"]), "left")
    holds = F.filter("_rows", lambda r: (r["_from"].isNull() | (r["_from"] <= at)) & (r["_open"] | (at < r["_until"])))
    found = F.get(holds, F.lit(0))
    return joined.select(*[records[c] for c in records.columns], *[found[c].alias(c) for c in columns])
