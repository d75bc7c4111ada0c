"""Chat formatting, quality rules and sharding."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tests.llm.conftest import SF_DIR, edge_rows
from tidings.llm import chat, quality, queries, sharding
from tidings.llm.oracles import ORACLES


def duck(folder):
    connection = duckdb.connect()
    for name in ("documents", "conversations"):
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            path += "/*.parquet" if os.path.isdir(path) else ""
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def compare(got, connection, name):
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == expected and expected


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    compare(queries.QUERIES[name](spark, SF_DIR), duck(SF_DIR), name)


# --- chats --------------------------------------------------------------------------------------

TURNS = [
    (1, 0, "user", "a<b>\\c \\l </turn>\n"), (1, 1, "assistant", "x<turn user>y\\\\<"), (1, 1, "assistant", ""),
    (1, None, "system", None), (2, 70, "assistant", "late"), (2, 3, None, "no role"), (2, 900, "user", "é😀\n"),
    (None, 0, "assistant", "nobody"), (3, 5, "a>b\n<", "role with marks"), (1, 1, "assistant", "x<turn user>y\\\\<"),
]


@pytest.fixture(scope="module")
def turns(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("chats"))
    rows = spark.createDataFrame(
        [(*r, "x", 1) for r in TURNS], "conv_id bigint, turn bigint, role string, text string, chunk string, parts int")
    rows.write.parquet(f"{path}/conversations.parquet")
    return path


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_turns_come_back(spark, turns):
    got = {r.conv_id: r for r in queries.op4_chats(spark, turns).collect()}
    rows = TURNS + [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        mine = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1], x[2] or "", x[3] or ""))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        loss = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(mine), digest(said))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))


def test_no_text_holds_a_mark(spark, turns):
    compare(queries.op4_chats(spark, turns), duck(turns), "op4_chats")
    typed = spark.read.parquet(f"{turns}/conversations.parquet").select(
        "conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    for r in chat.format_chats(typed).collect():
        assert r.formatted.count("<turn ") == r.formatted.count("</turn>\n") == r.n_turns
        assert r.formatted.count("<") == r.formatted.count(">") == 2 * r.n_turns


def test_no_conversations_and_very_long_texts(spark, tmp_path):
    ddl = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r.conv_id for r in queries.op4_chats(spark, f"{tmp_path}/none").collect()] == [-7]
    long = "a<b>\\ é" * 200_000
    spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], ddl).write.parquet(
        f"{tmp_path}/long/conversations.parquet")
    got = {r.conv_id: r for r in queries.op4_chats(spark, f"{tmp_path}/long").collect()}
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(long), digest(long))
    assert got[1].turns_sha256 == digest(f"user\n{long}\nassistant\n{long}\n")


def test_typed_parts(spark):
    def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (kind, text, ref, width, height, seconds, pages)
    rows = [
        (1, 0, "user", [part("text", "see <here> "), part("image", ref="i.png", width=57, height=28),
                        part("text", " and "), part("audio", ref="a.wav", seconds=2.02), part("document", ref="d", pages=3)]),
        (1, 1, "assistant", [part("image", ref="j.png"), part(None, "plain"), part("other", "odd"), part("text")]),
        (1, 2, "assistant", None), (1, 3, "user", []),
    ]
    got = chat.format_chats(spark.createDataFrame(
        rows, f"conv_id int, turn int, role string, parts array<{chat.PART}>")).collect()
    assert len(got) == 1
    assert got[0].formatted == (
        "<turn user>see \\lhere\\g <image 1> and <audio 2><document 3></turn>\n"
        "<turn assistant><image 1>plainodd</turn>\n<turn assistant></turn>\n<turn user></turn>\n")
    assert [tuple(a) for a in got[0].attachments] == [
        (0, 1, "image", "i.png", 3), (0, 2, "audio", "a.wav", 51), (0, 3, "document", "d", 1536), (1, 1, "image", "j.png", 1)]
    spans = [got[0].formatted[s.start : s.start + s.length] for s in got[0].loss_spans]
    assert spans == ["<image 1>plainodd", ""]
    assert chat.format_chats(spark.createDataFrame([], f"conv_id int, turn int, role string, parts array<{chat.PART}>")).count() == 0


# --- quality ------------------------------------------------------------------------------------

def measured(text):
    text = text or ""
    w, lines = plain.words(text), [x for x in text.split("\n") if plain.words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures(edge):
    got = quality.judged(edge).collect()
    expected = sorted(str((r[0], *measured(r[1]))) for r in edge_rows())
    assert sorted(str((r.doc_id, *(r[m] for m in quality.MEASURES))) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_edge_rows_against_sql(spark, folder, empty):
    single = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    other = f"{folder}/single"
    single.write.mode("overwrite").parquet(f"{other}/documents.parquet")
    compare(queries.op6_quality(spark, other), duck(other), "op6_quality")
    compare(queries.op5_near_duplicates(spark, other), duck(other), "op5_near_duplicates")
    assert quality.judged(empty).count() == 0


def test_hosts_are_condemned_by_their_shrunk_rates(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{good} {i}", f"h{i % 10}") for i in range(1000)]
    rows += [(2000 + i, "short", "bad") for i in range(90)] + [(3000 + i, f"{good} {i}", "bad") for i in range(10)]
    rows += [(4000, "short", "tiny"), (4001, good, "tiny"), (4002, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert all(got[i].kept for i in range(1000))
    assert not any(got[i].kept for i in range(3000, 3010)) and not got[3000].base_failed
    assert got[4001].kept and not got[4000].kept and got[4002].kept


def test_passing_rows_stay_as_they_came(edge):
    kept = sorted(str(tuple(r)) for r in quality.passing(edge).collect())
    assert set(kept) <= {str(r) for r in edge_rows()} and kept
    assert quality.passing(edge).schema == edge.schema


# --- shards -------------------------------------------------------------------------------------

def check_shards(rows, texts, shards=24):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((x or "").encode()) + 8, zlib.crc32((x or "").encode())) for i, x in texts)
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    loads = Counter()
    for r in rows:
        assert 0 <= r.shard < shards
        loads[r.shard] += r.size
    return [loads[s] for s in range(shards)]


def test_shards(spark, docs):
    got = queries.op9_shards(spark, SF_DIR).collect()
    loads = check_shards(got, [(d.doc_id, d.text) for d in docs])
    mean, largest = sum(loads) / 24, max(r.size for r in got)
    assert max(loads) <= mean * 1.001 + largest
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    again = queries.op9_shards(spark, SF_DIR).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_many_rows_are_balanced(spark):
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    loads = [r.n for r in sharding.shard_rows(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    mean = sum(loads) / 24
    assert len(loads) == 24 and max(loads) < 1.004 * mean and min(loads) > 0.95 * mean


def test_a_hot_text_without_ids(spark):
    docs = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    loads = [r.n for r in sharding.shard_rows(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(loads) == 24 and max(loads) < 1.01 * sum(loads) / 24


def test_few_rows_move_to_a_new_shard(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.xxhash64("id") % 400 + 400).cast("int")).alias("text"))
    before, after = (
        {r.doc_id: (r.cell, r.shard) for r in sharding.shard_rows(docs, shards=n).collect()} for n in (24, 25))
    assert all(before[i][0] == after[i][0] for i in before)
    # 1/25 has to move; the rest is overflow of the bound.
    assert 0.03 < sum(before[i][1] != after[i][1] for i in before) / 20_000 < 0.15


def test_edge_shards(edge, empty):
    check_shards(sharding.shard_rows(edge).collect(), [r[:2] for r in edge_rows()])
    check_shards(sharding.shard_rows(edge, shards=1).collect(), [r[:2] for r in edge_rows()], 1)
    assert sharding.shard_rows(empty).count() == 0


def test_native(spark):
    for name in ("op4_chats", "op6_quality", "op9_shards"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
