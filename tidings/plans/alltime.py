"""The all-time pair table, kept as counts by day: only days with new files are counted again.

    <root>/counts/state=<n>/ds=<day>    counts of the days that state n has counted
    <root>/days/state=<n>               for every day, the state whose counts hold
    <root>/batches/state=<n>            the ledger's batches that state n has added

A state is complete once its ``days`` are written, which is the last step, and readers take the
newest complete one. So a day is replaced for all readers at once, and an update that stops before
its end is made again from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.files import day_of
from tidings.operators.cooccurrence import cooccurrence_counts, ranked_pairs
from tidings.session import path_exists, subfolders
from tidings.sources.sinks import write_dataset
from tidings.streaming.ledger import load_ingested, load_ledger

_COUNTS = "name_a string, name_b string, count bigint, ds int, state int"
# Files without a day in their name.
NO_DAY = 0


def _states(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete states, in order."""
    found = subfolders(spark, f"{root}/days")
    numbers = (int(x.removeprefix("state=")) for x in found if x.startswith("state="))
    return sorted(n for n in numbers if path_exists(spark, f"{root}/days/state={n}/_SUCCESS"))


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path)


def _days(spark: SparkSession, root: str, state: int | None) -> DataFrame:
    if state is None:
        return spark.createDataFrame([], "ds int, state int")
    return _read(spark, f"{root}/days/state={state}", "ds int, state int")


def _added(spark: SparkSession, root: str, states: list[int]) -> DataFrame:
    """Batches that complete states have taken in."""
    if not states:
        return spark.createDataFrame([], "batch string")
    return _read(spark, f"{root}/batches", "batch string, state int").where(F.col("state").isin(states)).select("batch")


def update_pairs(spark: SparkSession, stored: str, root: str, col: str = "AllNames", kind: str = "gkg") -> list[int]:
    """Count the days that got files since the last update; returns them.

    ``stored`` is what the ledger's ingest writes. A day is counted from all its rows, so a file
    that comes late for an old day replaces that day's counts and touches no other. Days of files
    without a day in their name are counted together. Only one update may run at a time.
    """
    root = root.rstrip("/")
    states = _states(spark, root)
    newest = states[-1] if states else None
    number = (newest or 0) + 1
    ledger = load_ledger(spark, stored)
    fresh = ledger.select("batch").distinct().join(_added(spark, root, states), "batch", "left_anti")
    write_dataset(fresh, f"{root}/batches/state={number}", (), mode="overwrite")
    fresh = _read(spark, f"{root}/batches/state={number}", "batch string")
    files = ledger.where(F.col("dataset") == kind).join(fresh, "batch", "left_semi")
    changed = files.select(F.coalesce(day_of("source_file"), F.lit(NO_DAY)).alias("ds")).distinct()
    days = sorted(r.ds for r in changed.collect())  # one a day
    if not days:
        return []
    dated = [d for d in days if d != NO_DAY]
    wanted = F.col("ds").isin(dated)
    if NO_DAY in days:
        wanted = wanted | F.col("ds").isNull()
    rows = load_ingested(spark, stored, kind).where(wanted).select(F.coalesce("ds", F.lit(NO_DAY)).alias("ds"), col)
    counts = cooccurrence_counts(rows, col, directed=False, by=("ds",))
    write_dataset(counts, f"{root}/counts/state={number}", mode="overwrite")
    old = _days(spark, root, newest).where(~F.col("ds").isin(days))
    new = changed.select("ds", F.lit(number).alias("state"))
    write_dataset(old.unionByName(new), f"{root}/days/state={number}", (), mode="overwrite")
    return days


def day_counts(spark: SparkSession, root: str) -> DataFrame:
    """``ds, name_a, name_b, count`` of the newest complete state, in one direction."""
    root = root.rstrip("/")
    states = _states(spark, root)
    if not states:
        return spark.createDataFrame([], "ds int, name_a string, name_b string, count bigint")
    counts = _read(spark, f"{root}/counts", _COUNTS)
    # Days and states are partitions: what is replaced is not read.
    return counts.join(_days(spark, root, states[-1]), ["ds", "state"], "left_semi").select("ds", "name_a", "name_b", "count")


def alltime_pairs(spark: SparkSession, root: str) -> DataFrame:
    """``rn, name_a, name_b, count, weight`` over all days, from the counts by day. Runs jobs."""
    counts = day_counts(spark, root).groupBy("name_a", "name_b").agg(F.sum("count").alias("count"))
    return ranked_pairs(counts)
