from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import plain
from tests.llm.conftest import SF_DIR, edge_rows
from tidings import session
from tidings.llm import components, neardup, queries


def test_every_coordinate_is_filled_and_estimates_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    sets = [base[:1], base[:3], base[:1000], base[150:1150], base[:0]]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    got = neardup.similarity_sketches(np.concatenate(sets), owner, len(sets), 180)
    assert (got[:4] != np.uint64(2**64 - 1)).all() and (got[4] == np.uint64(2**64 - 1)).all()
    assert abs((got[2] == got[3]).mean() - 850 / 1150) < 0.12
    alone = neardup.similarity_sketches(sets[3], np.zeros(1000, int), 1, 180)
    assert (alone[0] == got[3]).all()
    bands = neardup.band_hashes(got[:4], 6)
    assert len(set(bands[2].tolist())) == 30 and (bands[2] == bands[3]).any()


def test_linked_sets_against_pairs():
    rng = random.Random(4)
    for _ in range(30):
        base = rng.sample(range(1, 10_000), 60)
        sets = [np.unique(np.array(rng.sample(base, rng.randint(40, 60)) + [rng.randint(1, 9)], np.uint64)) for _ in range(12)]
        left = np.array([i < 5 for i in range(12)])
        for side in (None, left):
            root = list(range(12))
            for a in range(12):
                for b in range(a):
                    both = len(np.intersect1d(sets[a], sets[b]))
                    if 100 * both >= 70 * (len(sets[a]) + len(sets[b]) - both) and (side is None or side[a] != side[b]):
                        x, y = root[a], root[b]
                        root = [x if r == y else r for r in root]
            mine = list(range(12))
            for a, b in neardup.linked(sets, side, 70):
                x, y = mine[a], mine[b]
                mine = [x if r == y else r for r in mine]
            assert len(set(zip(root, mine))) == len(set(root)) == len(set(mine))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(1, 300), rng.randint(1, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5001 + i) for i in range(500)] + [(7, None), (None, 3), (8, 8)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rounds_end_with_stars_and_store_few_files(spark, monkeypatch):
    stored = []

    def stage(df, label):
        out = session.stage(df, label)
        stored.append((label, len(out.inputFiles())))
        return out
    monkeypatch.setattr(components, "stage", stage)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        stars = [(k % 40, 100 + k) for k in range(500)]
        got = {r.node: r.component for r in components.components(spark.createDataFrame(stars, "a bigint, b bigint")).collect()}
        assert got == {k: k for k in range(40)} | {b: a for a, b in stars}
        assert [label for label, _ in stored] == ["edges", "least"]
        stored.clear()
        chain = [(k, k + 1) for k in range(500)]
        got = components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
        assert {r.node: r.component for r in got} == dict.fromkeys(range(501), 0)
        assert max(files for _, files in stored[1:]) <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check(rows, ids_texts, least):
    expected = plain.components(ids_texts, least)
    assert sorted(str((r.doc_id, r.n_shingles)) for r in rows) == sorted(
        str((i, len(plain.shingles(x)))) for i, x in ids_texts)
    for r in rows:
        if r.doc_id is not None:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_query(spark, docs):
    check(queries.op5_near_duplicates(spark, SF_DIR).collect(), [(d.doc_id, d.text) for d in docs], 85)


def test_edge_rows(spark, folder, empty):
    rows = queries.op5_near_duplicates(spark, folder).collect()
    check(rows, [r[:2] for r in edge_rows()], 85)
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert neardup.near_duplicates(empty).count() == 0


def variants(n, seed):
    """Copies of one text with some words changed, so that many pairs lie near the threshold."""
    rng = random.Random(seed)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(200)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("tile", [8, 192])
def test_a_large_group_of_near_copies(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    texts = variants(150, 1) + variants(60, 2) + ["a b c d e f"] * 50
    rows = [(i, x) for i, x in enumerate(texts)] + [(None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (80, 85, 95):
        check(neardup.near_duplicates(docs, least).collect(), rows, least)


def test_deduplicated_rows_stay_as_they_came(edge):
    got = sorted(map(str, (tuple(r) for r in neardup.deduplicated(edge).collect())))
    ids = plain.components([r[:2] for r in edge_rows()], 85)
    assert set(got) <= {str(r) for r in edge_rows()}
    kept = [r for r in edge_rows() if r[0] is None or ids[r[0]] == r[0]]
    assert len(got) == len({(r[0], r[1]) for r in kept})
    assert neardup.deduplicated(edge).schema == edge.schema
