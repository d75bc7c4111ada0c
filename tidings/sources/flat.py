"""Parquet files in one flat folder, as an earlier writer stored them with inferred types.

Two files of one dataset need not agree in a column's type. The files are grouped by the types they
were stored with, each group is read by Spark's own reader under its stored types, and the columns
are cast to the declared ones. Row groups are split over tasks, and filters and the choice of columns
reach the scan of every group.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import files as f
from tidings.operators.records import day_number
from tidings.schemas import schema_of
from tidings.sources.archives import list_archives

# The functions below travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTERS = "path string, stored string"
# What a text has to look like to count as a number.
_WHOLE_NUMBER = r"^-?[0-9]{1,18}$"
_DECIMAL = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_LIMIT = float(1 << 63)


def _spark_type(kind: pa.DataType) -> str | None:
    """The type under which Spark reads a stored column; none where it holds nothing but nulls."""
    if pa.types.is_dictionary(kind):
        kind = kind.value_type
    if pa.types.is_null(kind):
        return None
    if pa.types.is_boolean(kind):
        return "boolean"
    if pa.types.is_uint64(kind):
        return "decimal(20,0)"
    if pa.types.is_integer(kind):
        return "bigint" if kind.bit_width == 64 or pa.types.is_uint32(kind) else "int"
    if pa.types.is_floating(kind):
        return "double" if kind.bit_width == 64 else "float"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_date(kind):
        return "date"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return "binary"


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stored column types of each file as Spark DDL, from its footer alone."""
    for batch in batches:
        paths, stored = batch.column("path").to_pylist(), []
        for path in paths:
            uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path))
            store, name = fs.FileSystem.from_uri(uri)
            with store.open_input_file(name) as file:
                fields = pq.read_schema(file)
            kinds = ((x.name, _spark_type(x.type)) for x in fields)
            stored.append(", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in sorted(kinds, key=lambda x: x[0]) if k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(stored, pa.string())], ["path", "stored"])


def stored_types(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``path, stored``: the types of every file's columns, read from the footers by the executors."""
    listed = list_archives(spark, path, glob).select("path")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listed.repartition(partitions, "path").mapInArrow(_footers, FOOTERS)


def declared(column: str, stored: T.DataType, kind: T.DataType) -> Column:
    """A column stored by inference as the declared type; what does not fit becomes NULL.

    Inference makes decimals of whole numbers with gaps, and text of columns with one odd value. NaN
    stands for a gap. A number in a text column is written without a fraction where it has none: one
    rule for each value, whatever else its file holds.
    """
    value = F.col(f"`{column}`")
    if isinstance(stored, T.BinaryType):
        value, stored = value.cast("string"), T.StringType()
    if isinstance(stored, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
        whole = F.when(F.abs(value) < _LIMIT, value.cast("bigint"))
        if isinstance(kind, T.StringType):
            return F.when(whole.cast("double") == value, whole.cast("string")).otherwise(value.cast("string"))
        if isinstance(kind, (T.IntegerType, T.LongType)):
            value = whole
    elif isinstance(stored, T.StringType) and not isinstance(kind, T.StringType):
        pattern = _DECIMAL if isinstance(kind, T.DoubleType) else _WHOLE_NUMBER
        value = F.when(value.rlike(pattern), value)
    elif not isinstance(stored, (T.StringType, T.NumericType)) and not isinstance(kind, T.StringType):
        return F.lit(None).cast(kind)  # no number
    return value if stored == kind else value.try_cast(kind)


def load_files(
    spark: SparkSession, path: str, day=None, kind: str = "gkg", columns: list[str] | None = None
) -> DataFrame:
    """Parquet files in one flat folder, told apart by the day their name starts with.

    ``columns`` names the columns to return, all of the dataset by default. A column a file does not
    have is NULL, one the dataset does not have is left out. Adds ``source_file`` and ``ds``, the day
    of the file. The footers are read by the executors when this is called; one row for each
    different set of types comes to the driver, with the files that have it. Without files there are
    no rows.
    """
    glob = "*.parquet" if day is None else f"{day_number(day)}*.parquet"
    fields = [c for c in schema_of(kind).fields if columns is None or c.name in columns]
    found = stored_types(spark, path, glob)
    groups = defaultdict(list)
    for row in found.groupBy("stored").agg(F.collect_list("path").alias("paths")).toLocalIterator():
        groups[row.stored] += row.paths
    out = None
    for stored, paths in sorted(groups.items()):
        rows = _group(spark, fields, T.StructType.fromDDL(stored) if stored else T.StructType(), sorted(paths))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame(
            [], T.StructType(fields).add("source_file", T.StringType()).add("ds", T.IntegerType()))
    return out


def _group(spark: SparkSession, fields: list[T.StructField], stored: T.StructType, paths: list[str]) -> DataFrame:
    """The files of one set of types."""
    types = {c.name: c.dataType for c in stored.fields}
    read = spark.read.schema(T.StructType([c for c in stored.fields if c.name in {x.name for x in fields}]))
    name = F.col("_metadata.file_name")
    cells = [
        (declared(c.name, types[c.name], c.dataType) if c.name in types else F.lit(None).cast(c.dataType)).alias(c.name)
        for c in fields]
    return read.parquet(*paths).select(*cells, name.alias("source_file"), f.day_of(name).alias("ds"))
