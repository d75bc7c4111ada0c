"""Shards of nearly equal size from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many places on a ring of hash values; a row belongs to the shard whose place
follows its own. A shard takes no more than its bound, and what it cannot take continues
clockwise to the next place of a shard with room. The ring is cut into a fixed number of cells, so
rows are counted into cells once and all further steps work on cells, whose number grows neither
with the data nor with the shards: a row stays in its cell when shards are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.session import stage

# A shard's bound is this much above the mean; places of a shard on the ring.
SLACK = 0.001
PLACES = 64
# A cell is the top bits of a row's hash; the ring has 2**31 positions.
RING_BITS = 31
CELL_BITS = 20


def _spread(value: Column, salt: str) -> Column:
    """A hash from 0 to 2**31 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), value), 33)


def ring(spark: SparkSession, shards: int, places: int = PLACES) -> DataFrame:
    """``shard, at, place``: places in the order of the ring, numbered from 0.

    The places of a shard are the same on every ring with as many places a shard.
    """
    ids = spark.range(shards * places)
    points = ids.select(
        F.floor(F.col("id") / places).cast("int").alias("shard"), _spread(F.col("id"), "place").alias("at"))
    order = Window.orderBy("at", "shard")
    return points.withColumn("place", F.row_number().over(order) - 1)


def cell_of(doc_id: Column, text: Column) -> Column:
    """The cell of a row, whatever the number of shards; rows without id are spread by their text."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.xxhash64(text).cast("string")))
    return F.shiftright(_spread(key, "row"), RING_BITS - CELL_BITS).cast("int")


def _first_places(cells: DataFrame, places: DataFrame) -> DataFrame:
    """``cell, bytes, place, shard``: the first place at or behind each cell, going round."""
    last = F.shiftright("at", RING_BITS - CELL_BITS)
    order = Window.orderBy("place")  # over the places alone
    arcs = places.select(
        "place", "shard", last.alias("last"), F.lag(last, 1, -1).over(order).alias("before"))
    end = places.agg(F.max(last).alias("before"))
    behind_all = places.where("place = 0").crossJoin(F.broadcast(end)).select(
        "place", "shard", F.lit((1 << CELL_BITS) - 1).cast("bigint").alias("last"), "before")
    owned = arcs.unionByName(behind_all).where("before < last").select(
        "place", "shard", F.explode(F.sequence((F.col("before") + 1).cast("int"), F.col("last").cast("int"))).alias("cell"))
    return cells.join(owned, "cell").select("cell", "bytes", "place", "shard")


def _next_places(places: DataFrame, loads: DataFrame, bound: int, least: int) -> DataFrame:
    """``place, to, to_shard``: the next place, going round, whose shard has room for ``least``."""
    room = F.lit(bound) - F.coalesce("load", F.lit(0))
    marked = places.join(F.broadcast(loads), "shard", "left").select(
        "place", F.when(room >= least, F.struct("place", "shard")).alias("open"), F.lit(0).alias("lap"))
    twice = marked.unionByName(marked.withColumn("lap", F.lit(1)))
    after = Window.orderBy("lap", "place").rowsBetween(1, Window.unboundedFollowing)
    found = F.first("open", ignorenulls=True).over(after)
    return twice.withColumn("next", found).where("lap = 0").select(
        "place", F.col("next.place").alias("to"), F.col("next.shard").alias("to_shard"))


def place_cells(cells: DataFrame, shards: int, slack: float = SLACK) -> DataFrame:
    """``cell, shard`` from ``cell, bytes``, with every shard's bytes within one bound.

    Rounds: every waiting cell asks the shard at its place; a shard takes what fits below the
    mean times ``1 + slack``, the largest first, and keeps it; the rest goes on to the next place
    of a shard that has room for the smallest cell that waits. Where no shard has, the bound is
    raised by that cell. Each round is a small job over at most ``2 ** CELL_BITS`` rows; only sums come
    to the driver.
    """
    total = cells.agg(F.sum("bytes")).first()[0]
    if not total:
        return cells.select("cell", F.lit(0).alias("shard"))
    bound = int(total / shards * (1 + slack)) + 1
    places = stage(ring(cells.sparkSession, shards), "ring")
    placed = _first_places(cells, places).withColumn("fixed", F.lit(False))
    while True:
        mine = Window.partitionBy("shard")
        load = F.coalesce(F.sum(F.when(F.col("fixed"), F.col("bytes"))).over(mine), F.lit(0))
        in_turn = mine.orderBy(F.desc("could"), F.desc("bytes"), "cell")
        asked = placed.withColumn("load", load)
        could = ~F.col("fixed") & (F.col("bytes") <= F.lit(bound) - F.col("load"))
        asked = asked.withColumn("could", could)
        taken = F.col("could") & (F.sum("bytes").over(in_turn) <= F.lit(bound) - F.col("load"))
        asked = stage(asked.select("cell", "bytes", "place", "shard", (F.col("fixed") | taken).alias("fixed")), "cells")
        least = asked.where("NOT fixed").agg(F.min("bytes")).first()[0]
        if least is None:
            return asked.select("cell", "shard")
        loads = asked.where("fixed").groupBy("shard").agg(F.sum("bytes").alias("load"))
        lowest = loads.agg(F.min("load"), F.count("*")).first()
        lowest = lowest[0] if lowest[1] == shards else 0
        if lowest + least > bound:
            bound = lowest + least
        hops = _next_places(places, loads, bound, least)
        stays = F.col("fixed")
        placed = asked.join(F.broadcast(hops), "place").select(
            "cell", "bytes", "fixed",
            F.when(stays, F.col("place")).otherwise(F.col("to")).alias("place"),
            F.when(stays, F.col("shard")).otherwise(F.col("to_shard")).alias("shard"))


def shard_rows(docs: DataFrame, shards: int = 24, slack: float = SLACK, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, cell, shard, slot`` of every row; the law is ``bytes``.

    Size is the text's bytes plus 8; a null text is empty, rows without id are spread by their
    text, repeated rows go where the first goes and get slots of their own. Slots count from 0 in
    every shard without gaps, by cell, then id, then the checksum of the text. An empty table
    gives no rows; other columns are not read.

    Rows are shuffled once, without their texts, by cell. Shards are far too few to be a key.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        cell_of(F.col(id_col), text).alias("cell"),
    )
    counts = stage(rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "cells")
    homes = place_cells(counts.select("cell", "bytes"), shards, slack)
    earlier = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.join(homes, "cell").select(
        "cell", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("cell").orderBy(t.id_or_lowest("doc_id"), "text_crc32", "size")
    # One row a cell: too many for a broadcast, and the rows are dealt by cell already.
    return (
        rows.withColumn("in_cell", F.row_number().over(inside) - 1)
        .join(bases.hint("merge"), "cell")
        .select("doc_id", "size", "text_crc32", "cell", "shard",
                (F.col("base") + F.col("in_cell")).cast("bigint").alias("slot"))
    )
