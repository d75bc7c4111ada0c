"""Events next to the mentions of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.sources.bucketed import HEAVY_ROWS, Bucketed

# Fixed value: the column both datasets share.
EVENT_KEY = "GLOBALEVENTID"

Days = tuple[int | None, int | None]


def _prefixed(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """The key, and the other columns by names that cannot clash with those of events."""
    return df.select(key, *[F.col(c).alias(f"mention_{c}") for c in columns])


def events_with_mentions(
    events: Bucketed,
    mentions: Bucketed,
    event_columns: list[str],
    mention_columns: list[str],
    event_days: Days = (None, None),
    mention_days: Days = (None, None),
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Each event with each of its mentions, and events without mentions once.

    Both tables lie in the same number of buckets by the event's id, at least as many as there are
    shuffle partitions, so neither is shuffled; days are partition filters on both sides. Mentions of heavy events lie apart: they are dealt over
    several keys, at most ``heavy_rows`` or so to each, and meet a copy of the event there. Mention
    columns are named ``mention_<column>`` and are null for an event without mentions. Mentions
    without an event are left out, as are events without id and all that repeats is repeated.
    """
    key = events.key
    wanted = list(dict.fromkeys([key, *event_columns]))
    happened = events.rows(*event_days).where(F.col(key).isNotNull()).select(*wanted)
    light = _prefixed(mentions.rows(*mention_days), mention_columns, key)
    heavy = _prefixed(mentions.heavy(*mention_days), mention_columns, key)
    # Few: one in ``heavy_rows`` rows at most.
    parts = heavy.groupBy(key).agg(F.ceil(F.count("*") / heavy_rows).cast("int").alias("_parts"))
    out = _near(happened, light, parts, key).unionByName(_far(happened, heavy, parts, key))
    # Events that repeat so often that they lie apart themselves.
    apart = events.heavy(*event_days).select(*wanted)
    return out.unionByName(apart.join(light.unionByName(heavy), key, "left").select(*out.columns))


def _near(happened: DataFrame, light: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Events with what lies in the same bucket; only the list of heavy events is shuffled or sent."""
    rows = happened.join(light.withColumn("_found", F.lit(True)), key, "left").join(parts, key, "left")
    # A heavy event without light mentions has its rows among the far ones.
    return rows.where("_found OR _parts IS NULL").drop("_found", "_parts")


def _far(happened: DataFrame, heavy: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Heavy events, copied to as many keys as their mentions are dealt over."""
    of_part = F.pmod(F.xxhash64(*heavy.columns, F.monotonically_increasing_id()), F.col("_parts")).cast("int")
    dealt = heavy.join(parts, key).withColumn("_part", of_part).drop("_parts")
    copies = happened.join(parts, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return copies.drop("_parts").join(dealt, [key, "_part"]).drop("_part")
