"""Ranking by links against a plain walk, hubs, steps that end by themselves."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidings.operators import links


def plain(pairs, names=(), steps=50, damping=0.85):
    out = defaultdict(Counter)
    for a, b, n in pairs:
        if a < b:
            out[a][b] += n
            out[b][a] += n
    every = sorted(set(out) | set(names))
    rank = dict.fromkeys(every, 1 / len(every))
    for _ in range(steps):
        lost = sum(rank[x] for x in every if x not in out)
        new = dict.fromkeys(every, (1 - damping + damping * lost) / len(every))
        for a, others in out.items():
            whole = sum(others.values())
            for b, n in others.items():
                new[b] += damping * rank[a] * n / whole
        rank = new
    return rank


def made(n_names=40, n_pairs=120, seed=4):
    rng = random.Random(seed)
    found = Counter()
    for _ in range(n_pairs):
        a, b = sorted(rng.sample(range(n_names), 2))
        found[f"n{a:02}", f"n{b:02}"] += rng.randint(1, 9)
    return [(a, b, n) for (a, b), n in found.items()]


def table(spark, rows):
    return spark.createDataFrame(rows, "name_a string, name_b string, count bigint")


def named(spark, names):
    return spark.createDataFrame([(x,) for x in names], "name string")


def check(rows, expected):
    assert {r.name for r in rows} == set(expected)
    for r in rows:
        assert r.rank == pytest.approx(expected[r.name], abs=2e-7)
    assert [r.rn for r in rows] == list(range(1, len(rows) + 1))
    assert [(r.rank, r.name) for r in rows] == sorted(((r.rank, r.name) for r in rows), key=lambda x: (-x[0], x[1]))
    assert sum(r.rank for r in rows) == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("hub_links", [100_000, 2])
def test_ranks_are_those_of_the_walk(spark, hub_links):
    pairs, alone = made(), ["alone", "n01", "alone", None]
    got = links.link_rank(table(spark, pairs), named(spark, alone), tolerance=1e-8, hub_links=hub_links).orderBy("rn")
    check(got.collect(), plain(pairs, ["alone"]))


def test_steps_end_when_ranks_stand_still(spark, monkeypatch):
    steps = []
    step = links._step
    monkeypatch.setattr(links, "_step", lambda *a: steps.append(1) or step(*a))
    pairs = [("a", "b", 3), ("b", "c", 3), ("a", "c", 3)]
    rows = links.link_rank(table(spark, pairs)).collect()
    assert len(steps) == 1 and [r.name for r in sorted(rows, key=lambda r: r.rn)] == ["a", "b", "c"]
    assert {r.links for r in rows} == {2}


def test_both_directions_self_pairs_and_nulls(spark):
    pairs = made(12, 20)
    both = pairs + [(b, a, n) for a, b, n in pairs] + [("n01", "n01", 50), (None, "n02", 5), ("n02", None, 5)]
    one = links.link_rank(table(spark, pairs), iterations=6, tolerance=-1.0).collect()
    two = links.link_rank(table(spark, both), iterations=6, tolerance=-1.0, buckets=3, hub_links=3).collect()
    assert sorted(one) == sorted(two)


def test_nothing_and_names_without_links(spark):
    assert links.link_rank(table(spark, [])).collect() == []
    rows = links.link_rank(table(spark, []), named(spark, ["b", "a"])).orderBy("rn").collect()
    assert [(r.rn, r.name, r.links, r.rank) for r in rows] == [(1, "a", 0, 0.5), (2, "b", 0, 0.5)]


def test_a_hub_is_dealt_over_keys_and_its_links_stay(spark):
    star = table(spark, [(f"l{i:05}", "m", 1) for i in range(3000)])
    stored, degrees = links._stored_links(star, 8, hub_links=100)
    of_hub = stored.where("src = 'm'").groupBy("part").count().collect()
    assert len(of_hub) == 30 and max(r["count"] for r in of_hub) < 200
    ranks = degrees.select(
        F.col("src").alias("name"), F.lit(1000).cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("before"),
        "links", F.ceil(F.col("links") / 100).cast("int").alias("parts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = links._step(stored, ranks, 0, 85)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # What is given and the sums are shuffled, the links are not.
    assert plan.count("Exchange") == 2 and "Bucketed: true" in plan and "partial_sum" in plan
