"""Continuous ingest: landed archives become typed, day-partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidings.functions import files as f
from tidings.schemas import DATASETS, parse_schema
from tidings.sources.archives import read_archives, unzip_lines
from tidings.sources.datasets import parse_lines, read_dataset

_MARK_OF = {dataset: mark for mark, dataset in f.DATASET_MARKS.items()}


def _with_origin(
    rows: DataFrame, kind: str, name: Column, error: Column, replaced: Column
) -> DataFrame:
    return rows.select(
        *parse_schema(kind).names,
        F.lit(kind).alias("dataset"),
        name.alias("source_file"),
        F.current_timestamp().alias("ingest_time"),
        error.cast("string").alias("ingest_error"),
        replaced.cast("boolean").alias("bytes_replaced"),
        F.when(error.isNull(), f.day_of(name)).alias("ds"),
    )


def typed_archives(archives: DataFrame, kind: str) -> DataFrame:
    """Typed rows of the archives that belong to ``kind``, with their origin.

    An unreadable archive or member gives one row without ``ds`` and with
    ``ingest_error``; a malformed line keeps its text in ``_corrupt_record``,
    and ``bytes_replaced`` marks a line with bytes that are not UTF-8.
    """
    wanted = archives.where(f.dataset_of("path") == kind)
    rows = parse_lines(unzip_lines(wanted), kind)
    return _with_origin(rows, kind, f.base_name("path"), F.col("error"), F.col("replaced"))


def typed_texts(rows: DataFrame, kind: str) -> DataFrame:
    """The same for rows of ``read_dataset``."""
    name = F.col("_metadata.file_name")
    rows = rows.where(f.dataset_of(name) == kind)
    return _with_origin(rows, kind, name, F.lit(None), F.lit(None))


def start_ingest(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    datasets: tuple[str, ...] = tuple(DATASETS),
    zipped: bool = True,
    every: str | None = None,
    files_per_batch: int = 1000,
    max_file_age: str = "36500d",
    clean: str = "off",
    clean_to: str | None = None,
) -> dict[str, StreamingQuery]:
    """One query per dataset, from files in ``source`` to gzip Parquet in ``root/<dataset>``.

    The files are zip archives, or with ``zipped=False`` the ``.csv`` files that
    archives hold. Each file is taken once, by its name without the folder,
    however often the queries are restarted. ``every`` is the time between
    batches (for example ``"60 seconds"``); without it the queries take what is
    there and end. ``clean`` is ``off``, ``archive`` (to ``clean_to``) or
    ``delete``, for files that have been processed. ``files_per_batch`` bounds a
    batch after a pause.

    A file older than the newest one by more than ``max_file_age`` is neither taken nor
    remembered, so a shorter age drops late files and may store a name twice. The default forgets
    nothing; what is remembered, one name a file, is held by the driver and grows with the files.

    The stored folder has a log of its files: nothing else may write there.
    """
    options = {
        "fileNameOnly": "true",
        "maxFilesPerTrigger": str(files_per_batch),
        "maxFileAge": max_file_age,
        "cleanSource": clean,
    }
    if clean_to:
        options["sourceArchiveDir"] = clean_to
    trigger = {"processingTime": every} if every else {"availableNow": True}

    queries = {}
    for kind in datasets:
        mark = _MARK_OF[kind]
        if zipped:
            archives = read_archives(spark, source, f"*{mark}*.zip", streaming=True, **options)
            rows = typed_archives(archives, kind)
        else:
            glob = f"*{mark}*.[cC][sS][vV]"
            texts = read_dataset(
                spark, source, kind, streaming=True, pathGlobFilter=glob, **options
            )
            rows = typed_texts(texts, kind)
        queries[kind] = (
            rows.writeStream.queryName(f"ingest-{kind}")
            .format("parquet")
            .option("path", f"{root.rstrip('/')}/{kind}")
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{kind}")
            .option("compression", "gzip")
            .partitionBy("ds")
            .trigger(**trigger)
            .start()
        )
    return queries
