"""Large tables stored by day and in buckets by key, so that joins by the key need no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.session import drop_staged, shuffles_dropped, stage

# Cells (rows times columns) that are shuffled at a time: some 8 bytes each, and a row up to twice.
PASS_CELLS = 100_000_000
# Rows of one key that stay in the buckets; more are stored apart.
HEAVY_ROWS = 1_000_000


@dataclass(frozen=True)
class Bucketed:
    """A stored table: the rows in buckets, and the rows of heavy keys in plain files by day."""

    spark: SparkSession
    table: str
    heavy_path: str
    key: str

    def rows(self, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
        """The rows in buckets; days are partition filters."""
        return _on_days(self.spark.table(self.table), first_day, last_day)

    def heavy(self, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
        """The rows of heavy keys."""
        schema = self.spark.table(self.table).schema
        return _on_days(self.spark.read.schema(schema).parquet(self.heavy_path), first_day, last_day)


def _on_days(df: DataFrame, first: int | None, last: int | None) -> DataFrame:
    if first is not None:
        df = df.where(F.col("ds") >= first)
    return df if last is None else df.where(F.col("ds") <= last)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, heavy_rows: int = HEAVY_ROWS,
    compression: str = "gzip",
) -> Bucketed:
    """Store rows with a day ``ds`` as the table ``table`` under ``path``, in buckets by ``key``.

    Rows whose key has more than ``heavy_rows`` rows go to plain files by day, where any number of
    tasks can read them: a bucket is read by one task. Keys are counted within the tasks first, and
    only heavy ones are joined back, of which there are at most one in ``heavy_rows`` rows. Rows
    without a key are stored in the buckets. Large tables are written some buckets at a time, and
    what was shuffled for these is dropped before the next. ``df`` is read again for each, so it
    should be stored itself.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    often = df.groupBy(key).count().where(F.col("count") > heavy_rows).where(F.col(key).isNotNull()).select(key)
    # Stored, its size is known, and rows need no shuffle to meet a few keys.
    often = stage(often, "often")
    columns = [c for c in df.columns if c != "ds"] + ["ds"]
    with shuffles_dropped(spark):
        passes = max(1, min(buckets, -(-df.count() * len(columns) // PASS_CELLS)))
    for number in range(passes):
        # The number of the row's bucket decides, so each bucket is written by one pass.
        some = df.where(F.pmod(F.hash(key), F.lit(buckets)) % passes == number) if passes > 1 else df
        # The hint deals rows as the buckets do and gathers or splits by size.
        light = some.join(often, key, "left_anti").select(*columns).hint("rebalance", buckets, key)
        heavy = some.join(often, key, "left_semi").select(*columns).hint("rebalance", "ds")
        mode = "append" if number else "error"
        with shuffles_dropped(spark):
            light.write.mode(mode).bucketBy(buckets, key).option("compression", compression).option(
                "path", f"{path}/buckets").partitionBy("ds").saveAsTable(table)
            heavy.write.mode(mode).option("compression", compression).partitionBy("ds").parquet(f"{path}/heavy")
    drop_staged(often)
    return Bucketed(spark, table, f"{path}/heavy", key)
