"""Names, pairs, counts, ranks and weights on small inputs worked out by hand."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidings.functions import entities
from tidings.operators import cooccurrence as cooc
from tidings.operators import mentions, ranking, records

BASKETS = ["A,1;B,2", "A,1;B,2;A,3", "C,1", "A,1;", None]
EDGE = ["Smith, John,5;B,2", ";;", ";", "A;B", " A,1;a,2", "é,1;日本,2", "X,1;X,9", ""]


def frame(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "id bigint, AllNames string")


def names_of(text):
    return [item.split(",")[0] for item in text.split(";")]


def brute(lists, drop_empty=False):
    """Pair counts the slow way."""
    counts = Counter()
    for text in lists:
        if text is None or ";" not in text:
            continue
        names = [n for n in names_of(text) if n or not drop_empty]
        counts.update(itertools.product(names, names))
    return dict(counts)


def as_dict(df):
    return {(r.name_a, r.name_b): r["count"] for r in df.collect()}


def test_ranked_table_by_hand(spark):
    rows = cooc.cooccurrence(frame(spark, BASKETS)).orderBy("rn").collect()
    assert [tuple(r)[:4] for r in rows] == [
        (1, "A", "A", 6), (2, "A", "B", 3), (3, "B", "A", 3), (4, "B", "B", 2),
        (5, "", "", 1), (6, "", "A", 1), (7, "A", "", 1),
    ]
    assert [r.weight for r in rows] == [r["count"] / 17 for r in rows]


def test_multi_entity_keeps_lists_of_several(spark):
    kept = records.multi_entity(frame(spark, BASKETS)).collect()
    assert sorted(r.AllNames for r in kept) == ["A,1;", "A,1;B,2", "A,1;B,2;A,3"]


def test_pairs_equal_plain_product(spark):
    pairs = cooc.entity_pairs(frame(spark, EDGE + [None]), "id", tile=2).collect()
    got = {(r.id, r.name_a, r.name_b): r["count"] for r in pairs}
    expected = Counter(
        (i, a, b) for i, x in enumerate(EDGE) for a, b in itertools.product(*[names_of(x)] * 2)
    )
    assert got == expected


def test_sql_function_equals_plain_product(spark):
    entities.register_functions(spark)
    rows = spark.sql(
        "SELECT AllNames, get_cooccurences(AllNames) AS pairs FROM {df}", df=frame(spark, EDGE)
    ).collect()
    for row in rows:
        names = names_of(row.AllNames)
        assert [tuple(p) for p in row.pairs] == list(itertools.product(names, names))


@pytest.mark.parametrize("tile", [1, 2, 3, 64])
@pytest.mark.parametrize("drop_empty", [False, True])
def test_counts_equal_brute_force(spark, tile, drop_empty):
    lists = BASKETS + EDGE + [";".join(f"n{i % 7},{i}" for i in range(23)), ";;;;"]
    got = cooc.cooccurrence_counts(frame(spark, lists), drop_empty=drop_empty, tile=tile)
    assert as_dict(got) == brute(lists, drop_empty)


def test_tiles_are_dealt_to_tasks_that_are_not_merged(spark):
    tasks = cooc.SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for options in ({}, {"directed": False, "self_pairs": False}):
        plan = cooc.cooccurrence_counts(frame(spark, BASKETS), **options)._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(left.*, right.*, {tasks}\), REPARTITION_BY_NUM", plan)


name = st.text(alphabet="ABé ,", max_size=3)
basket = st.one_of(st.none(), st.lists(name, max_size=9).map(";".join))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lists=st.lists(basket, min_size=1, max_size=8), tile=st.integers(1, 5))
def test_any_lists(spark, lists, tile):
    df = frame(spark, lists)
    expected = brute(lists)
    assert as_dict(cooc.cooccurrence_counts(df, tile=tile)) == expected
    assert cooc.total_pairs(df).first().total == sum(expected.values())


def test_options(spark):
    df = frame(spark, BASKETS)
    one_way = as_dict(cooc.cooccurrence_counts(df, directed=False))
    assert one_way == {p: n for p, n in brute(BASKETS).items() if p[0] <= p[1]}
    no_self = as_dict(cooc.cooccurrence_counts(df, self_pairs=False))
    assert no_self == {p: n for p, n in brute(BASKETS).items() if p[0] != p[1]}
    assert cooc.total_pairs(df, drop_empty=True).first().total == 4 + 9 + 1


def test_top_equals_head_of_full_table(spark):
    lists = [";".join(f"n{(i * j) % 11},{i}" for i in range(12)) for j in range(1, 9)]
    df = frame(spark, lists)
    full = cooc.cooccurrence(df).orderBy("rn").limit(15).collect()
    assert cooc.cooccurrence_top(df, 15).orderBy("rn").collect() == full


def test_hot_record_and_hot_copies(spark):
    """A third of the rows are copies of one record, and one record is very long."""
    hot = ";".join(f"hub,{i}" for i in range(50)) + ";x,1"
    long = ";".join(f"w{i},{i}" for i in range(400))
    lists = [hot] * 40 + [long] + [f"a{i},1;hub,2" for i in range(80)]
    assert as_dict(cooc.cooccurrence_counts(frame(spark, lists))) == brute(lists)


def test_empty_input(spark):
    df = frame(spark, ["one,1", None])
    assert cooc.cooccurrence(df).collect() == []
    assert cooc.cooccurrence_top(df, 3).collect() == []
    assert cooc.total_pairs(df).first().total == 0


def test_pair_array_view(spark):
    rows = cooc.with_pair_array(cooc.cooccurrence(frame(spark, ["A;B"]))).collect()
    assert rows[0].cooccurence == ["A", "A"] and rows[0].asDict().keys() == {
        "rn", "cooccurence", "count", "weight"
    }


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("partitions", ["1", "8", "50"])
def test_rank_equals_global_window(spark, partitions, adaptive):
    before = {k: spark.conf.get(k) for k in (SHUFFLE, ADAPTIVE)}
    spark.conf.set(SHUFFLE, partitions)
    spark.conf.set(ADAPTIVE, adaptive)
    try:
        check_rank(spark)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("directed, self_pairs, drop_empty", [(True, True, False), (False, False, True), (False, True, True)])
@pytest.mark.parametrize("a_pass", [7, 40])
def test_pairs_counted_in_passes(spark, monkeypatch, a_pass, directed, self_pairs, drop_empty):
    lists = ["B,1;A,2;B,3", "A;A;;C", "B,1;A,2;B,3", None, "alone", ";", ";".join(f"n{i % 13}" for i in range(40))]
    df = spark.createDataFrame([(x,) for x in lists], "AllNames string")
    options = {"self_pairs": self_pairs, "drop_empty": drop_empty, "tile": 5}
    wanted = cooc.cooccurrence_counts(df, directed=directed, **options).collect()
    passes, count = [], cooc._counted
    monkeypatch.setattr(cooc, "_counted", lambda *a, **k: passes.append(1) or count(*a, **k))
    monkeypatch.setattr(cooc, "PASS_PAIRS", a_pass)
    got = cooc.cooccurrence(df, directed=directed, **options).collect()
    assert len(passes) > 2
    assert {(r.name_a, r.name_b, r["count"]) for r in got} == set(map(tuple, wanted)) and len(got) == len(wanted)


def test_rank_over_several_files_a_task(spark):
    df = spark.range(0, 500, 1, 5).select((F.col("id") * 7919 % 500).alias("key"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        got = ranking.rank_rows(df, F.asc("key"), total_of="key")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted(map(tuple, got.select("key", "rn", "total").collect())) == [(i, i + 1, 124_750) for i in range(500)]
    # The stored rows have no column of numbers.
    assert spark.read.parquet(got.staged_path).columns == ["key"]


SHUFFLE, ADAPTIVE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"


def check_rank(spark):
    df = spark.range(5000).select(
        F.pmod(F.xxhash64("id"), F.lit(7)).alias("count"), F.col("id").cast("string").alias("key")
    )
    order = Window.orderBy(F.desc("count"), F.asc("key"))
    expected = df.withColumn("rn", F.row_number().over(order).cast("bigint"))
    got = ranking.rank_by_count(df, "key").select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and got.count() == 5000


THEMES = ["A;B", "A;B", "B", None, "A;"]


def test_mentions_of_items(spark):
    df = spark.createDataFrame([(t,) for t in THEMES], "Themes string")
    assert [tuple(r) for r in mentions.top_mentions(df, "Themes").collect()] == [("A", 3), ("B", 3)]
    kept = mentions.top_mentions(df, "Themes", drop_empty=False).collect()
    assert [tuple(r) for r in kept] == [("A", 3), ("B", 3), ("", 1)]


def test_mentions_of_whole_strings(spark):
    df = spark.createDataFrame([(t,) for t in THEMES], "Themes string")
    rows = mentions.top_mentions(df, "Themes", exploded=False).collect()
    assert {r.Themes: r["count"] for r in rows} == {"A;B": 2, "B": 1, "A;": 1, None: 1}


def test_name_counts_in_sql(spark):
    """The SQL function gives the same runs as the column function."""
    entities.register_functions(spark)
    df = spark.createDataFrame(
        [("B,1;A,2;B,3;;",), ("",), (None,), ("x",), (";".join(f"n{i % 700}" for i in range(2000)),)],
        "AllNames string")
    got = spark.sql(
        "SELECT AllNames, name_counts(AllNames) AS runs FROM {df}", df=df)
    rows = got.select("runs", entities.name_runs(entities.entity_names("AllNames")).alias("wanted")).collect()
    assert [r.runs for r in rows] == [r.wanted for r in rows]
    assert sum(x.n for x in rows[-1].runs) == 2000


# --- the table function ---------------------------------------------------------------------------

def test_pairs_as_rows(spark):
    from itertools import product

    from tidings.functions.pairs import register_pairs

    register_pairs(spark)
    lists = ["a,1;b,2;a,3", "x", "", None, "a;;b,;", "é;é,9"]
    spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, names string").createOrReplaceTempView("lists")
    rows = spark.sql("SELECT name_a, name_b, sum(n) AS n FROM name_pairs(TABLE(SELECT names FROM lists)) GROUP BY ALL").collect()
    expected = Counter()
    for text in lists:
        if text is not None:
            names = [x.split(",")[0] for x in text.split(";")]
            expected.update(product(names, names))
    assert {(r.name_a, r.name_b): r.n for r in rows} == expected


@pytest.mark.parametrize("waiting", [1, 10, 1_000_000])
def test_half_of_the_pairs_adds_up_to_all(monkeypatch, waiting):
    """What the table function gives with ``true``: no mirrors, copies counted, blocks of any size."""
    from tidings.functions import pairs

    monkeypatch.setattr(pairs, "WAITING_ROWS", waiting)
    monkeypatch.setattr(pairs, "BLOCK_ROWS", min(waiting, 7))
    half, got, expected = pairs.HalfPairs(), Counter(), Counter()
    blocks = []
    for copies, text in enumerate(EDGE + [";".join(f"n{i % 13},{i}" for i in range(40)), "é;a;é"], 1):
        names = names_of(text)
        blocks += half.add(Counter(names), copies)
        for a, b in itertools.product(names, names):
            expected[a, b] += copies
    for block in blocks + ([half.taken()] if half.size else []):
        for row in block.to_pylist():
            got[row["name_a"], row["name_b"]] += row["n"]
    assert got == {p: n for p, n in expected.items() if p[0] <= p[1]}


def test_half_of_the_pairs_in_sql(spark):
    from tidings.functions.pairs import register_pairs

    register_pairs(spark)
    spark.createDataFrame([("a,1;b,2;a,3", 2), ("b;a", 3), (None, 1), ("x", 1)], "names string, copies bigint").createOrReplaceTempView("copied")
    rows = spark.sql("SELECT name_a, name_b, sum(n) AS n FROM name_pairs(TABLE(SELECT names, copies FROM copied), true) GROUP BY ALL").collect()
    assert {(r.name_a, r.name_b): r.n for r in rows} == {("a", "a"): 11, ("a", "b"): 7, ("b", "b"): 5, ("x", "x"): 1}


def test_parts_of_a_list_bound_the_arrays_of_pairs(spark):
    entities.register_functions(spark)
    text = ";".join(f"n{i % 700:03},{i}" for i in range(2000))
    df = spark.createDataFrame([(text,), ("",), ("b;;a;b,1",), (None,)], "AllNames string")
    rows = spark.sql("""
        SELECT AllNames, parts, pairs, size(pairs) AS size FROM (
            SELECT AllNames, parts, get_cooccurences(parts[0].list, element_at(parts, -1).list) AS pairs
            FROM (SELECT AllNames, name_parts(AllNames) AS parts FROM {df}))""", df=df).collect()
    assert len(rows[0].parts) == 11 and rows[0].size == 64 * 60
    for row in rows[:3]:
        runs = Counter(names_of(row.AllNames))
        assert [x for p in row.parts for x in zip(p.list.split(";"), p.n)] == sorted(runs.items())
        first, last = (row.parts[i].list.split(";") for i in (0, -1))
        assert [tuple(p) for p in row.pairs] == list(itertools.product(first, last))
    assert rows[3].parts is None and rows[3].pairs is None


@pytest.mark.parametrize("query", ["cooc_sql_function", "cooc_sql_pairs", "cooc_sql_names"])
def test_mirrors_are_not_shuffled(spark, tmp_path, query):
    from tidings.plans.queries import QUERIES

    words = [" ".join(f"N{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)) for n in (300, 300, 2, 1, 0)]
    documents = spark.createDataFrame([(k, x) for k, x in enumerate(words)], "doc_id bigint, text string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES[query](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The mirror is added behind the last aggregation, and the lists are dealt to tasks of their own.
    assert re.search(r"Generate explode\(both", plan) and "REPARTITION_BY_NUM" in plan
    names = words[0].split()
    expected = Counter(itertools.product(names, names)) + Counter(itertools.product(names, names)) + Counter(itertools.product(names[:2], names[:2]))
    assert {(r.name_a, r.name_b): r["count"] for r in got.collect()} == expected


def test_a_record_of_many_names_is_a_stream_of_rows(spark):
    from tidings.functions.pairs import register_pairs

    register_pairs(spark)
    n = 20_000
    names = spark.range(1).select(F.concat_ws(";", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: F.concat(F.lit("n"), x))).alias("names"))
    names.createOrReplaceTempView("long_list")
    df = spark.sql("""
        SELECT count(*) AS rows, sum(n) AS pairs, count_if(name_a = name_b) AS same
        FROM name_pairs(TABLE(SELECT names FROM long_list))""")
    assert "array<array" not in df._jdf.queryExecution().executedPlan().toString()
    assert tuple(df.first()) == (n * n, n * n, n)
