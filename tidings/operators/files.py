"""Manifests and file lists: which archives exist, which are new, what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import files as f


def extract_urls(df: DataFrame, col: str = "value") -> DataFrame:
    """One row per address in ``col``, with the name of the file it points to."""
    return df.select(F.explode(f.urls_in(col)).alias("url")).withColumn(
        "file_name", f.base_name("url")
    )


def parse_manifest(df: DataFrame, col: str = "value") -> DataFrame:
    """Fields of manifest lines ``size checksum address``, one row per address."""
    lines = df.select(
        f.line_fields(col).alias("_fields"), F.explode(f.manifest_urls_in(col)).alias("url")
    )
    return lines.select(
        F.get("_fields", F.lit(0)).try_cast("bigint").alias("size"),
        F.get("_fields", F.lit(1)).alias("checksum"),
        "url",
        f.base_name("url").alias("file_name"),
        f.stamp_of("url").alias("stamp"),
        f.dataset_of("url").alias("dataset"),
    )


def latest_files(manifest: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest files by the stamp in their name."""
    return manifest.orderBy(F.desc("stamp"), F.desc("file_name")).limit(n)


def route_files(df: DataFrame, col: str = "file_name") -> DataFrame:
    """Add the dataset each file belongs to."""
    return df.withColumn("dataset", f.dataset_of(col))


def missing_files(lines: DataFrame, stored: DataFrame, col: str = "value") -> DataFrame:
    """``parse_manifest`` of the lines, without the files of which ``stored`` has rows.

    ``stored`` has ``source_file`` and is partitioned by ``ds``; only the days from the first to
    the last of the manifest are read, and the partition of names without a day.
    """
    manifest = parse_manifest(lines, col)
    day = f.day_of("file_name")
    first = manifest.select(F.min(day)).scalar()
    last = manifest.select(F.max(day)).scalar()
    near = stored.where(F.col("ds").isNull() | F.col("ds").between(first, last))
    names = near.select(F.col("source_file").alias("file_name")).distinct()
    return manifest.join(names, "file_name", "left_anti").select(*manifest.columns)


def only_new_files(incoming: DataFrame, stored: DataFrame, on: str = "source_file") -> DataFrame:
    """Incoming files whose name is not stored yet.

    ``stored`` may be the stored table itself, with one name per row: each task
    reduces its rows to distinct names before anything is shuffled.
    """
    return incoming.join(stored.select(on).distinct(), on, "left_anti").select(*incoming.columns)
