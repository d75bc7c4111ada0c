"""Expressions on file names, addresses, dates in names and manifest lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.columns import as_column

# Address patterns, and the marks by which file names tell the dataset.
# The first asks for two labels of a host and lets the rest run on: the same matches
# as a repeated label, whose nested loop overflows Java's stack on a long host.
URL_PATTERN = (
    r"(?:http|ftp|https)://[\w-]+\.[\w-]+(?:[\w.,@?^=%&:/~+#-]*[\w@?^=%&/~+#-])?"
)
MANIFEST_URL_PATTERN = r"(https?://[^\s]+)"
DATASET_MARKS = {"gkg": "gkg", "export": "events", "mentions": "mentions"}
OTHER = "other"


def base_name(c: str | Column) -> Column:
    """Part of a path or address after its last slash."""
    return F.substring_index(as_column(c), "/", -1)


def dataset_of(name: str | Column) -> Column:
    """Dataset of a file, by the first mark its *name* contains."""
    name = base_name(name)
    kind = F.lit(OTHER)
    for mark, dataset in reversed(DATASET_MARKS.items()):
        kind = F.when(name.contains(mark), dataset).otherwise(kind)
    return kind


def stamp_of(name: str | Column) -> Column:
    """Digits a file name starts with, ``yyyyMMddHHmmss``; NULL without them."""
    return F.nullif(F.regexp_extract(base_name(name), r"^([0-9]{14})", 1), F.lit(""))


def day_of(name: str | Column) -> Column:
    """Day of a file as an int ``yyyyMMdd``; NULL when the name has none."""
    day = F.regexp_extract(base_name(name), r"^([0-9]{8})", 1)
    return F.nullif(day, F.lit("")).cast("int")


def day_text(c: str | Column) -> Column:
    """Date or timestamp as ``yyyyMMdd``."""
    return F.date_format(as_column(c), "yyyyMMdd")


def stamp_time(c: str | Column) -> Column:
    """Time of a ``yyyyMMddHHmmss`` number or text; NULL for anything else."""
    return F.try_to_timestamp(as_column(c).cast("string"), F.lit("yyyyMMddHHmmss"))


def urls_in(c: str | Column) -> Column:
    """All http, https and ftp addresses in a text."""
    return F.regexp_extract_all(as_column(c), F.lit(URL_PATTERN), F.lit(0))


def manifest_urls_in(c: str | Column) -> Column:
    """All http and https addresses in a manifest line, up to the next blank."""
    return F.regexp_extract_all(as_column(c), F.lit(MANIFEST_URL_PATTERN), F.lit(1))


def line_fields(c: str | Column) -> Column:
    """Blank-separated fields of a line; no fields for a blank line."""
    fields = F.split(F.regexp_replace(as_column(c), r"^\s+|\s+$", ""), r"\s+")
    return F.filter(fields, lambda x: x != "")
