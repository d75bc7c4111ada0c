"""Entities ranked by their links: a name counts for more when it is named with names that do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators.ranking import rank_rows
from tidings.session import drop_staged, stage, stage_bucketed

# Ranks are whole parts of this number. Every link's share is rounded down to a part, so sums do
# not depend on their order and two runs agree to the last digit.
SCALE = 10**15
# Links of one name that a join key may hold; a name with more is split into several.
HUB_LINKS = 100_000


def _links(pairs: DataFrame) -> DataFrame:
    """``src, dst, weight`` in both directions; a name is not linked to itself."""
    there = F.struct(F.col("name_a").alias("src"), F.col("name_b").alias("dst"))
    back = F.struct(F.col("name_b").alias("src"), F.col("name_a").alias("dst"))
    # Of a table that has both directions one is taken.
    rows = pairs.where("name_a < name_b").select(F.explode(F.array(there, back)).alias("l"), "count")
    return rows.select("l.src", "l.dst", F.col("count").alias("weight"))


def _stored_links(pairs: DataFrame, buckets: int, hub_links: int) -> tuple[DataFrame, DataFrame]:
    """Links with their share of the source, in buckets, and the number of links of each source."""
    links = stage(_links(pairs), "links")
    of_source = links.groupBy("src").agg(F.sum("weight").alias("_all"), F.count("*").alias("links"))
    degrees = stage(of_source, "degrees")
    parts = F.ceil(F.col("links") / hub_links)
    shares = links.join(degrees, "src").select(
        "src", F.pmod(F.xxhash64("dst"), parts).cast("int").alias("part"), "dst",
        (F.col("weight").cast("double") / F.col("_all").cast("double")).alias("share"))
    stored = stage_bucketed(shares, "shares", buckets, "src", "part")
    drop_staged(links)
    return stored, degrees


def _step(links: DataFrame, ranks: DataFrame, base: int, damping: int) -> DataFrame:
    """The next ranks. Names go to their links, split by ``part``; the links stay where they are."""
    parts = F.sequence(F.lit(0), F.col("parts") - 1)
    sent = ranks.where("parts > 0").select(F.col("name").alias("src"), "rank", F.explode(parts).alias("part"))
    share = F.floor(F.col("rank").cast("double") * F.col("share")).cast("bigint")
    none = F.lit(None)
    moved = links.join(sent, ["src", "part"]).select(
        F.col("dst").alias("name"), share.alias("given"), none.cast("bigint").alias("before"),
        none.cast("bigint").alias("links"), none.cast("int").alias("parts"))
    kept = ranks.select("name", F.lit(0).cast("bigint").alias("given"), F.col("rank").alias("before"), "links", "parts")
    sums = moved.unionByName(kept).groupBy("name").agg(
        F.sum("given").alias("given"), *(F.max(c).alias(c) for c in ("before", "links", "parts")))
    rank = F.expr(f"{base} + given * {damping} div 100")
    return sums.select("name", rank.alias("rank"), "before", "links", "parts")


def link_rank(
    pairs: DataFrame,
    names: DataFrame | None = None,
    damping: int = 85,
    iterations: int = 50,
    tolerance: float = 1e-6,
    hub_links: int = HUB_LINKS,
    buckets: int | None = None,
) -> DataFrame:
    """``rn, name, links, rank``: the share of a walk over the links that ends at each name.

    ``pairs`` is a pair table (``name_a, name_b, count``) of one or both directions; a step of the
    walk follows a link with a chance in proportion to its count, and in ``100 - damping`` per cent
    of the cases goes anywhere. From a name without links it goes anywhere too; ``names`` (a column
    ``name``) adds such names, repeated ones count once. The steps end when the ranks change by no more than
    ``tolerance`` in sum, or after ``iterations``.

    The links are stored once, in buckets by source; each step shuffles ranks and what they give,
    summed within the tasks, and stores the new ranks in the work folder. A name with more than
    ``hub_links`` links is dealt over several keys. No row reaches the driver but one sum a step.
    Runs jobs. Equal ranks are in the order of their names. Null names are left out; without any
    name there are no rows.
    """
    spark = pairs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    linked = pairs.where("name_a IS NOT NULL AND name_b IS NOT NULL")
    links, degrees = _stored_links(linked, buckets, hub_links)
    all_names = degrees.select(F.col("src").alias("name"), "links")
    if names is not None:
        others = names.where("name IS NOT NULL").select("name", F.lit(0).cast("bigint").alias("links"))
        all_names = all_names.unionByName(others)
    counted = stage(all_names.groupBy("name").agg(F.max("links").alias("links")), "names")
    n = counted.count()
    first = F.lit(SCALE // max(n, 1)).cast("bigint")
    ranks = stage(
        counted.select(
            "name", first.alias("rank"), F.lit(0).cast("bigint").alias("before"), "links",
            F.ceil(F.col("links") / hub_links).cast("int").alias("parts")),
        "ranks")
    drop_staged(degrees, counted)
    for _ in range(iterations if n else 0):
        lost = ranks.where("links = 0").agg(F.coalesce(F.sum("rank"), F.lit(0))).first()[0]
        base = (SCALE * (100 - damping) + damping * lost) // (100 * n)
        following = stage(_step(links, ranks, base, damping), "ranks")
        drop_staged(ranks)
        ranks = following
        change = ranks.agg(F.sum(F.abs(F.col("rank") - F.col("before")))).first()[0]
        if change <= tolerance * SCALE:
            break
    placed = rank_rows(ranks, F.desc("rank"), F.asc("name"), stored=True)
    drop_staged(links, ranks)
    return placed.select("rn", "name", "links", (F.col("rank").cast("double") / F.lit(float(SCALE))).alias("rank"))
