"""Importance resampling against a plain computation."""

from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from tests.llm.conftest import SF_DIR, edge_rows
from tidings.llm import queries, resampling

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [crc32(x.encode()) % 10_000 for x in runs]


def plain(docs, target):
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(buckets(text)[1])
    for text in target:
        wanted.update(buckets(text)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000))))
        for b in range(10_000)]
    rows = []
    for i, text in docs:
        n, found = buckets(text)
        weight = sum(gain[b] for b in found)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0]))
    drawn = able[: 5 * len(able) // 100]
    rank = Counter()
    out = [(*r[:4], k) for k, r in enumerate(drawn, 1)]
    left = Counter(r[:4] for r in rows)
    left.subtract(Counter(r[:4] for r in drawn))
    assert not rank
    return sorted(map(str, out + [(*r, None) for r in left.elements()]))


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_features(docs, chunk, monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK_BYTES", chunk)
    for text in [d.text for d in docs[:40]] + [r[1] for r in edge_rows() if len(r[1] or "") < 5000] + ["É9ß a1 \x00B日"]:
        found = list(resampling.features((text or "").encode().translate(resampling.TABLE)))
        words, expected = buckets(text)
        assert sum(n for n, _ in found) == words
        assert Counter(x for _, some in found for x in some.tolist()) == Counter(expected)


def result(df):
    assert df.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    return sorted(str(tuple(r)) for r in df.collect())


def test_query(spark, docs):
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert result(queries.op12_resampling(spark, SF_DIR)) == plain([(d.doc_id, d.text) for d in docs], target)


def test_edge_rows(spark, edge, empty):
    rows = [r[:2] for r in edge_rows()] * 12
    many = edge
    for _ in range(11):
        many = many.unionByName(edge)
    target = spark.createDataFrame([("one two three",), (None,), ("",)], "text string")
    got = result(resampling.resampled(many, target))
    assert got == plain(rows, ["one two three", None, ""])
    assert any(not x.endswith("None)") for x in got)
    assert result(resampling.resampled(edge, target.limit(0))) == plain([r[:2] for r in edge_rows()], [])
    assert result(resampling.resampled(empty, target)) == []


def test_every_task_sends_a_row_a_bucket_at_most(spark, docs):
    texts = spark.createDataFrame([(False, d.text) for d in docs], "target boolean, text string").coalesce(2)
    plan = resampling.bucket_counts(texts)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange") == 1
