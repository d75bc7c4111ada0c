"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import drop_staged, stage


# Rows of a task that stores a table of a round.
TASK_ROWS = 100_000


def _gathered(df: DataFrame, edges: int) -> DataFrame:
    """As many tasks as the rows of a round need, and one a core at least.

    The rows are dealt by a hash and one for each key. Over all shuffle partitions a small graph
    takes longer to start tasks and to store their files than to link.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-2 * edges // TASK_ROWS)))


def _minimum(edges: DataFrame, *more: Column) -> DataFrame:
    """``u, m``: the least of a node and its neighbours; counted partially before the shuffle."""
    found = edges.groupBy("u").agg(F.min("v").alias("m"), *more)
    return found.withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the least node names a component.

    Two steps in turn until every node has one edge, to the least of its component: every node links
    its larger neighbours to the least of its neighbourhood, then its smaller ones and itself. The
    number of edges never grows and the rounds are about the logarithm of a component's size. Least
    neighbours come from a partial aggregation and are stored before they are joined back: both
    sides of the join are plain shuffles then, of which adaptive execution splits the rows of a node
    with very many neighbours over tasks. Every round is stored in the work folder, and dropped
    after the next. Null ends and loops are left out; without edges there are no rows.
    """
    now = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(now, "edges")
    count = now.count()
    lesser, most = F.count_if(F.col("v") < F.col("u")).alias("lesser"), F.max("v").alias("most")
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        nearest = stage(_gathered(_minimum(both, lesser, most), count), "least")
        # Two smaller neighbours, or smaller and larger ones: not yet a star around its least node.
        if nearest.where("lesser > 1 OR (lesser > 0 AND most > u)").isEmpty():
            drop_staged(nearest)
            break
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stage(_gathered(large.distinct(), count), "edges")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = stage(_gathered(_minimum(down), count), "least")
        small = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        following = stage(_gathered(small.where("a <> b").distinct(), count), "edges")
        drop_staged(now, nearest, large, least)
        now = following
    # Every node but the least of a component now has one edge, to the least.
    roots = _gathered(now.select(F.col("b").alias("node")).distinct(), count)
    roots = roots.withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
