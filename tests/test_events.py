"""Events with their mentions, over tables in buckets."""

from __future__ import annotations

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_session import no_more_than, shuffle_files
from tidings.operators import events
from tidings.operators.events import EVENT_KEY, events_with_mentions
from tidings.sources import bucketed
from tidings.sources.bucketed import write_bucketed

EVENTS = [(i, 20240100 + i % 5, f"c{i}") for i in range(40)] + [(7, 20240102, "twice"), (None, 20240101, "none")]
MENTIONS = (
    [(i, 20240103 + i % 3, f"s{i}") for i in range(0, 30, 2)]
    + [(8, 20240104, f"hot{k}") for k in range(500)] + [(9, 20240109, f"late{k}") for k in range(60)]
    + [(None, 20240103, "lost"), (999, 20240103, "no event"), (12, 20240103, "same"), (12, 20240103, "same")])


def store(spark, tmp_path, rows, ddl, heavy=20, buckets=8):
    name = f"t{uuid.uuid4().hex}"
    df = spark.createDataFrame(rows, ddl)
    return write_bucketed(df, name, f"{tmp_path}/{name}", EVENT_KEY, buckets, heavy)


@pytest.fixture
def stored(spark, tmp_path):
    return (store(spark, tmp_path, EVENTS, "GLOBALEVENTID bigint, ds int, EventCode string"),
            store(spark, tmp_path, MENTIONS, "GLOBALEVENTID bigint, ds int, Name string"))


def plain(event_days=(0, 99999999), mention_days=(0, 99999999), events=EVENTS, mentions=MENTIONS):
    out = Counter()
    for key, day, code in events:
        if key is None or not event_days[0] <= day <= event_days[1]:
            continue
        found = [n for k, d, n in mentions if k == key and mention_days[0] <= d <= mention_days[1]]
        out.update((key, code, n) for n in found or [None])
    return out


@pytest.mark.parametrize("days", [
    ((0, 99999999), (0, 99999999)), ((20240102, 20240103), (20240101, 20240104)), ((20240104, 20240104), (0, 20240103))])
@pytest.mark.parametrize("limit", [20, 100_000])
def test_rows_are_those_of_a_plain_join(stored, days, limit):
    got = events_with_mentions(*stored, ["EventCode"], ["Name"], *days, heavy_rows=limit)
    assert got.columns == [EVENT_KEY, "EventCode", "mention_Name"]
    assert Counter(map(tuple, got.collect())) == plain(*days)


def test_heavy_events_on_both_sides(spark, tmp_path):
    happened = [(1, 20240101, "a")] * 30 + [(2, 20240101, "b")]
    mentions = [(1, 20240101, "x")] * 25 + [(2, 20240102, "y"), (1, 20240109, "z")]
    ddl = "GLOBALEVENTID bigint, ds int, {} string"
    stored = store(spark, tmp_path, happened, ddl.format("EventCode")), store(spark, tmp_path, mentions, ddl.format("Name"))
    assert stored[0].heavy().count() == 30 and stored[1].heavy().count() == 26
    got = events_with_mentions(*stored, ["EventCode"], ["Name"], heavy_rows=10)
    assert Counter(map(tuple, got.collect())) == plain(events=happened, mentions=mentions)


def test_empty_tables(spark, tmp_path, stored):
    none = store(spark, tmp_path, [], "GLOBALEVENTID bigint, ds int, Name string")
    got = events_with_mentions(stored[0], none, ["EventCode"], ["Name"])
    assert Counter(map(tuple, got.collect())) == plain(mentions=[])
    none = store(spark, tmp_path, [], "GLOBALEVENTID bigint, ds int, EventCode string")
    assert events_with_mentions(none, stored[1], ["EventCode"], ["Name"]).collect() == []


def test_neither_side_is_shuffled_and_days_are_pruned(spark, stored):
    happened, said = (s.rows(20240102, 20240103) for s in stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = stored[1].heavy().groupBy(EVENT_KEY).agg(F.lit(1).alias("_parts"))
        near = events._near(happened.drop("ds"), said.drop("ds"), parts, EVENT_KEY)
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The one shuffle is that of the list of heavy events.
    assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 2
    assert plan.count("PartitionFilters: [isnotnull(ds") == 2


def test_heavy_mentions_are_dealt_over_keys(stored):
    rows = stored[1].heavy().groupBy(EVENT_KEY).count().collect()
    assert {(r[0], r["count"]) for r in rows} == {(8, 501), (9, 60)}
    assert stored[1].rows().where("GLOBALEVENTID IN (8, 9)").count() == 0


@pytest.mark.parametrize("cells", [50, 1000])
def test_large_tables_are_written_some_buckets_at_a_time(spark, tmp_path, stored, monkeypatch, cells):
    monkeypatch.setattr(bucketed, "PASS_CELLS", cells)
    before = shuffle_files(spark)
    parts = (store(spark, tmp_path, EVENTS, "GLOBALEVENTID bigint, ds int, EventCode string"),
             store(spark, tmp_path, MENTIONS, "GLOBALEVENTID bigint, ds int, Name string"))
    assert no_more_than(spark, before)
    for one, part in zip(stored, parts):
        for rows in ("rows", "heavy"):
            assert Counter(map(tuple, getattr(one, rows)().collect())) == Counter(map(tuple, getattr(part, rows)().collect()))
        # As many files as in one pass: a pass has whole buckets.
        files = [set(r[0].rsplit("_", 1)[1] for r in x.rows().select("_metadata.file_name").distinct().collect()) for x in (one, part)]
        assert files[0] == files[1]
    got = events_with_mentions(*parts, ["EventCode"], ["Name"], heavy_rows=20)
    assert Counter(map(tuple, got.collect())) == plain()
