"""Expressions on the list-in-a-string columns: ``name,offset;name,offset;...``."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidings.functions.columns import as_column

# Fixed values: ";" separates items, "," separates a name from its trailing fields.
ITEM_SEPARATOR = ";"
FIELD_SEPARATOR = ","


def split_items(c: str | Column) -> Column:
    """Items of the list, empty ones included."""
    return F.split(as_column(c), ITEM_SEPARATOR)


def item_count(c: str | Column) -> Column:
    """How many items ``split_items`` gives, without building the array."""
    c = as_column(c)
    return F.length(c) - F.length(F.replace(c, F.lit(ITEM_SEPARATOR), F.lit(""))) + 1


def entity_names(c: str | Column, drop_empty: bool = False) -> Column:
    """Name of each item: the part before its first comma."""
    names = F.transform(split_items(c), lambda x: F.substring_index(x, FIELD_SEPARATOR, 1))
    return F.filter(names, lambda x: x != "") if drop_empty else names


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable cannot be replaced by its definition when the optimizer
    merges projections or moves filters, a plain column can.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def name_runs(names: Column) -> Column:
    """Distinct names in order, each with its multiplicity: ``array<name, n>``."""

    def runs(ordered: Column) -> Column:
        at = F.transform(ordered, lambda x, i: F.struct(x.alias("name"), i.alias("at")))
        heads = F.filter(
            at, lambda e, i: (i == 0) | (F.get(ordered, i - 1) != e["name"])
        )
        return bind(heads, lambda h: F.transform(h, lambda e, i: F.struct(
            e["name"].alias("name"),
            (F.coalesce(F.get(h, i + 1)["at"], F.size(ordered)) - e["at"])
            .cast("bigint").alias("n"),
        )))

    return bind(F.sort_array(names), runs)


# ``name_runs`` as SQL: the places where a new name starts in the sorted list, and how far it
# is from each to the next.
COUNTS_SQL = """
    flatten(transform(array(array_sort({names})), o -> flatten(transform(
        array(filter(transform(o, (x, i) -> struct(x AS name, i AS at)),
                     e -> e.at = 0 OR get(o, e.at - 1) <> e.name)),
        h -> transform(h, (e, i) -> struct(e.name AS name,
            CAST(coalesce(get(h, i + 1).at, size(o)) - e.at AS BIGINT) AS n))))))
"""


# Names in one part of a list, as ``name_parts`` cuts it.
PART_NAMES = 64

# A pair of names and its mirror, or the pair alone where a name is with itself.
DIRECTIONS_SQL = """
    CASE WHEN name_a = name_b THEN array(struct(name_a, name_b))
         ELSE array(struct(name_a, name_b), struct(name_b AS name_a, name_a AS name_b)) END
"""


def register_functions(
    spark: SparkSession,
    pairs: str = "get_cooccurences",
    names: str = "entity_names",
    counts: str = "name_counts",
    parts: str = "name_parts",
    directions: str = "pair_directions",
) -> None:
    """Functions for SQL on a names string.

    ``pairs`` gives the array of ``[name, name]`` pairs, of one list or of one list with another. It
    holds the product of the numbers of names in one value, so it is for short lists: ``parts`` cuts
    the distinct names of a list in order into lists of at most ``PART_NAMES``, each ``(list, n)``
    with the multiplicities of its names. ``names`` gives the array of names. ``counts`` gives the
    distinct names in order, each with its multiplicity, as an array of ``(name, n)``: two ``LATERAL
    VIEW explode`` of it yield the pairs as rows that count ``a.n * b.n`` times, so a list of any
    length is a stream of rows and never one value. ``directions`` gives a pair and its mirror, for
    pairs that were counted with ``name_a <= name_b`` only. A generator over ``pairs`` needs the call
    in a subquery. ``operators.cooccurrence`` also spreads the rows of one long list over several
    tasks.
    """
    # Fixed value: the default for ``pairs``, as existing SQL text calls it.
    name_of = f"substring_index(x, '{FIELD_SEPARATOR}', 1)"
    array = f"transform(split(list, '{ITEM_SEPARATOR}'), x -> {name_of})"
    other = f"transform(split(coalesce(others, list), '{ITEM_SEPARATOR}'), x -> {name_of})"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {names}(list STRING)
        RETURNS ARRAY<STRING> RETURN {array}
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {counts}(list STRING)
        RETURNS ARRAY<STRUCT<name: STRING, n: BIGINT>>
        RETURN {COUNTS_SQL.format(names=array)}
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {parts}(list STRING)
        RETURNS ARRAY<STRUCT<list: STRING, n: ARRAY<BIGINT>>>
        RETURN flatten(transform(array({COUNTS_SQL.format(names=array)}), c ->
            transform(transform(sequence(0, (size(c) - 1) div {PART_NAMES}), i -> slice(c, i * {PART_NAMES} + 1, {PART_NAMES})),
                p -> struct(array_join(transform(p, r -> r.name), '{ITEM_SEPARATOR}') AS list, transform(p, r -> r.n) AS n))))
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {pairs}(list STRING, others STRING DEFAULT NULL)
        RETURNS ARRAY<ARRAY<STRING>>
        RETURN flatten(transform(array(struct({array} AS l, {other} AS r)),
            n -> flatten(transform(n.l, a -> transform(n.r, b -> array(a, b))))))
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {directions}(name_a STRING, name_b STRING)
        RETURNS ARRAY<STRUCT<name_a: STRING, name_b: STRING>> RETURN {DIRECTIONS_SQL}
    """)
