"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidings", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        # A small row of names becomes thousands of pairs, so a partition is worth
        # keeping at a size where others would be merged.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides, or the checkpoint folder the application has set; without
    them the configured warehouse, which is shared as well. A folder of one machine is refused
    unless the master is local, where the one machine sees everything. A ``file:`` folder may be
    a mount that all machines have, so it is tried before it is refused.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.work"
    )
    if store_of(spark, folder) == "file" and not context.master.startswith("local"):
        try:
            shared = is_shared(spark, folder)
        except Exception as error:
            raise ValueError(f"set spark.checkpoint.dir to a folder shared by the cluster, {folder} fails") from error
        if not shared:
            raise ValueError(f"set spark.checkpoint.dir to a folder shared by the cluster, not {folder}")
    return folder


# Folders that were tried, by application.
_tried: dict[tuple[str, str], bool] = {}


def is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether what tasks write to a folder is there for the driver and for other tasks; tried once.

    A row for each core of the cluster is written by a task of its own and read back.
    """
    app = spark.sparkContext.applicationId
    if (app, folder) not in _tried:
        tasks = max(spark.sparkContext.defaultParallelism, 2)
        rows = spark.range(0, tasks, 1, tasks)
        path = f"{folder.rstrip('/')}/{app}/try-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(path)
            found = spark.read.schema(rows.schema).parquet(path)
            _tried[app, folder] = sorted(r.id for r in found.collect()) == list(range(tasks))
        finally:
            drop_path(spark, path)
    return _tried[app, folder]


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def store_of(spark: SparkSession, folder: str) -> str:
    """The scheme of the store that holds a folder, with the cluster's default for none."""
    # Not every store implements getScheme(), all have an address.
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the work folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{work_folder(spark).rstrip('/')}/{app}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store Spark can reach."""
    found = _path(spark, path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = _path(spark, path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether anything exists under a path or a pattern of paths."""
    found = _path(spark, pattern)
    return bool(found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    if not path_exists(spark, path):
        return []
    found = _path(spark, path)
    listed = found.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(found)
    return [x.getPath().getName() for x in listed if x.isDirectory()]


# Spark 4.1 and later; set for a session.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files.

    They would stay on the executors' disks until the driver happens to collect its garbage, and
    what is stored is never shuffled for again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the work folder and return it read back.

    Cuts the lineage: what follows survives the loss of executors without
    computing ``df`` again, and each reader scans only the columns it needs.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with shuffles_dropped(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def stage_bucketed(df: DataFrame, label: str, buckets: int, *by: str) -> DataFrame:
    """Write ``df`` to the work folder in ``buckets`` by some columns and return it as a table.

    A join or aggregation by these columns reads the buckets as they lie: only the other side is
    shuffled, however often the table is used.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    table = f"{label}_{path.rsplit('-', 1)[1]}"
    # The hash that deals the rows is the one of the buckets: a task writes one file.
    dealt = df.repartition(buckets, *by)
    dealt.write.bucketBy(buckets, *by).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.staged_path, out.staged_table = path, table
    return out


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        if getattr(table, "staged_table", None):
            table.sparkSession.sql(f"DROP TABLE IF EXISTS {table.staged_table}")
        drop_path(table.sparkSession, table.staged_path)
