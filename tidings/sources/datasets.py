"""Typed datasets: from text lines, from text files, from the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidings.operators.records import master_view, multi_entity, on_day
from tidings.schemas import CORRUPT, parse_schema, schema_of

# What ingest adds to every row.
ORIGIN = (
    f"dataset string, source_file string, ingest_time timestamp, {CORRUPT} string, "
    "ingest_error string, bytes_replaced boolean, ds int"
)
_TEXT = {"sep": "\t", "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_dataset(
    spark: SparkSession, path: str | list[str], kind: str, streaming: bool = False, **options
) -> DataFrame:
    """Tab-separated files without header, under the column list of the dataset.

    Every line is kept; one with too few, too many or unreadable fields is
    repeated in ``_corrupt_record``.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.schema(parse_schema(kind)).options(**_TEXT, **options).csv(path)


def parse_lines(df: DataFrame, kind: str, col: str = "line") -> DataFrame:
    """As ``read_dataset``, for lines in a column; the other columns stay."""
    ddl = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in parse_schema(kind))
    others = [c for c in df.columns if c != col]
    parsed = df.select(*others, F.from_csv(F.col(col), ddl, _TEXT).alias("_row"))
    return parsed.select(*others, "_row.*")


def _stored(spark: SparkSession, root: str, kind: str) -> DataFrame:
    schema = StructType(schema_of(kind).fields + StructType.fromDDL(ORIGIN).fields)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{kind}")


def load_records(spark: SparkSession, root: str, day=None, kind: str = "gkg") -> DataFrame:
    """A stored dataset, all of it or one day; the day is a partition filter.

    The rows that stand for unreadable archives are in ``load_quarantine`` only.
    """
    stored = _stored(spark, root, kind).where("ingest_error IS NULL")
    return stored if day is None else on_day(stored, day)


def load_quarantine(spark: SparkSession, root: str, kind: str = "gkg") -> DataFrame:
    """Archives and members that could not be read: their file, time and error."""
    stored = _stored(spark, root, kind).where("ds IS NULL AND ingest_error IS NOT NULL")
    return stored.select("dataset", "source_file", "ingest_time", "ingest_error")


def register_views(spark: SparkSession, root: str, day) -> None:
    """The record table as views for SQL, of all time and of one day."""
    for suffix, records in (("", load_records(spark, root)),
                            ("_today", load_records(spark, root, day))):
        records.createOrReplaceTempView(f"records{suffix}")
        master = master_view(records)
        master.createOrReplaceTempView(f"master{suffix}")
        multi_entity(master).createOrReplaceTempView(f"multi_entity{suffix}")
