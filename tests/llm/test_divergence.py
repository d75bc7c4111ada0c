"""Divergences of sources against a plain computation."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.conftest import SF_DIR
from tests.llm.test_native import compare, duck
from tidings.llm import divergence, queries

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=10):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang, source in counts:
        kept = {t for t, n in docs[lang].items() if n >= least}
        sources = [s for x, s in counts if x == lang]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = shares(counts[lang, source])

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        pairs = []
        for other in sources:
            if other != source:
                q = shares(counts[lang, other])
                pairs.append((sum(f(p[t], q[t]) for t in kept), other))
        q = shares(whole)
        terms = [(f(p[t], q[t]), t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items, top in (("pair", pairs, None), ("term", terms, 10)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, x, v, k) for k, (v, x) in enumerate(items[:top], 1)]
    return sorted(map(str, out))


def result(df):
    assert df.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                         ("value", "bigint"), ("rank", "int")]
    return sorted(str(tuple(r)) for r in df.collect())


def test_query(spark, docs):
    assert result(queries.op13_divergence(spark, SF_DIR)) == plain([(d.lang, d.source, d.text) for d in docs])


def test_edge_rows(edge, empty, folder, spark):
    rows = [(r.lang, r.source, r.text) for r in edge.collect()]
    for least in (1, 2, 10):
        assert result(divergence.audit(edge, least)) == plain(rows, least)
    compare(queries.op13_divergence(spark, folder), duck(folder), "op13_divergence")
    assert result(divergence.audit(empty)) == []


def made_rows():
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "abcdé" for b in "xyzß" for c in "mno"]
    rows = []
    for k in range(900):
        source = f"h{min(int(rng.expovariate(0.08)), 69)}" if k % 3 else "hot"
        lang = None if k % 11 == 0 else "en"
        rows.append((lang, source, " ".join(rng.choices(words[: 10 + hash(source) % 7 * 8], k=rng.randint(0, 30)))))
    return rows + [("xx", "a", "only once"), ("xx", "b", None), ("yy", None, None), ("zz", "s", "")]


@pytest.mark.parametrize("held", [250_000, 40])
def test_many_blocks_give_what_one_gives(spark, held, monkeypatch):
    """Blocks of a few groups and terms, a hot group, counting in many parts."""
    for name, value in (("GROUPS", 4), ("TERMS", 7), ("HELD_TERMS", held)):
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr(divergence, "group_totals", _small_blocks(divergence.group_totals))
    rows = made_rows()
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert result(divergence.audit(docs)) == plain(rows)


def _small_blocks(whole):
    return lambda terms: whole(terms, groups=4, block_terms=7)


def test_cells_are_small(spark):
    docs = spark.createDataFrame(made_rows(), "lang string, source string, text string")
    terms = divergence.term_counts(docs)
    groups = divergence.group_totals(terms, groups=4, block_terms=7).collect()
    assert max(r.group_blocks for r in groups) > 10 and max(r.term_blocks for r in groups) > 5
    sizes = Counter((r.lang, r.block) for r in groups)
    assert max(sizes.values()) < 16


def test_one_shuffle_counts_the_terms(spark, docs):
    df = spark.createDataFrame([(d.lang, d.source, d.text) for d in docs], "lang string, source string, text string")
    plan = divergence.term_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@given(st.lists(st.integers(0, 2**50), min_size=1, max_size=5), st.integers(0, 2**50), st.integers(1, 2**20))
def test_shares_are_exact(counts, rest, v):
    total = sum(counts) + rest
    if total + 2 * v < 2**53:
        got = divergence._shares(np.array([counts]), np.array([total]), v)[0].tolist()
        assert got == [1 + 10**9 * (n + 2) // (total + 2 * v) for n in counts]
