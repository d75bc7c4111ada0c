from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import plain
from tidings.llm import fingerprint as f
from tidings.llm import textops as t

TEXT = st.text(alphabet="ab B\t\n\x0b\x85é😀", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=8))
def test_shingles_are_those_of_the_words(texts):
    got = list(t.shingles(pa.array(texts, pa.string())))
    assert [len(set(h.tolist())) for h in got] == [len(plain.shingles(x)) for x in texts]
    names = {}
    for text, hashes in zip(texts, got):
        w = [x.translate(plain.LOWER) for x in plain.words(text)]
        listed = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        for shingle, value in zip(listed, hashes.tolist(), strict=True):
            assert names.setdefault(shingle, value) == value


def test_slices_and_slabs_change_nothing(monkeypatch):
    texts = [None, "a b", "", "x " * 50, "c d e f g h", "q" * 90, None]
    column = pa.array(["skipped", *texts])[1:]
    whole = [h.tolist() for h in t.shingles(column)]
    monkeypatch.setattr(t, "SLAB_BYTES", 40)
    assert [h.tolist() for h in t.shingles(column)] == whole


def test_sketches_merge():
    rng = np.random.default_rng(1)
    for size in (0, 1, 3, 10, 2000):
        a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (size, 500))
        together = f.sketch(np.concatenate([a, b]))
        assert f.merge(f.sketch(a), f.sketch(b)).tolist() == together.tolist()
        assert f.from_text(f.to_text(together)).tolist() == together.tolist()


def test_containment_of_unequal_texts():
    rng = random.Random(3)
    long = [str(rng.random()) for _ in range(60_000)]
    column = pa.array([" ".join(long), " ".join(long[:6000] + [str(rng.random()) for _ in range(6000)])])
    big, small = (f.sketch(np.unique(h)) for h in t.shingles(column))
    assert abs(f.likeness(small, big)[1] - 0.5) < 0.06
    assert abs(f.likeness(big, small)[1] - 0.1) < 0.03


def expected(rows):
    key = {i: (r[0] is not None, r[0] or 0) for i, r in enumerate(rows)}
    order = sorted(range(len(rows)), key=key.get)
    out = []
    for at, i in enumerate(order):
        text, after = rows[i][1] or "", rows[order[(at + 1) % len(order)]][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((rows[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_edited_texts(spark, docs):
    table = spark.createDataFrame(docs).repartition(5)
    rows = f.edited_fingerprints(table).collect()
    assert sorted(map(tuple, [r[:3] for r in rows])) == sorted(expected([(d.doc_id, d.text) for d in docs]))
    by_id, ordered = {r.doc_id: r for r in rows}, sorted(docs, key=lambda d: d.doc_id)
    errors = []
    for d, n in zip(ordered, ordered[1:] + ordered[:1]):
        r, half = by_id[d.doc_id], len(d.text) // 2
        own, after = plain.shingles(d.text), plain.shingles(n.text)
        new = plain.shingles(d.text[: len(d.text) - half] + n.text[:half])
        assert r.fingerprint == by_id[d.doc_id].fingerprint
        if d.text == n.text:
            assert r.near_next == 1 and r.fingerprint == by_id[n.doc_id].fingerprint
        errors += [abs(r.near_edited - len(own & new) / len(own | new))] if len(own) > 400 else []
        assert own & after or r.near_next == 0
    assert np.mean(errors) < 0.08


def test_error_over_all_documents(docs):
    """Every text against itself with its last half replaced, short ones too."""
    texts = [d.text for d in docs]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, texts[1:] + texts[:1])]
    whole = [[np.unique(h) for h in t.shingles(pa.array(x, pa.string()))] for x in (texts, edited)]
    errors, sizes = [], []
    for own, new in zip(*whole):
        true = f.likeness(own, new)[0]
        errors.append(f.likeness(f.sketch(own), f.sketch(new))[0] - true)
        sizes.append(len(own))
    errors, sizes = np.array(errors), np.array(sizes)
    short = errors[sizes < 160]
    assert len(short) > 20
    assert np.sqrt(np.mean(errors**2)) < 0.05 and np.sqrt(np.mean(short**2)) < 0.08


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_edge_rows(spark, edge, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = f.edited_fingerprints(edge).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(rows) == edge.count()
    # Equal ids come in the order of a hash, so only ids of one row are compared here.
    source = [(r.doc_id, r.text) for r in edge.collect()]
    single = [r for r in expected(source) if r[0] not in (None, 8, 9, 17)]
    assert set(single) <= {tuple(r[:3]) for r in rows}
    blank = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert all(r.fingerprint == "" for r in blank) and [r.near_next for r in sorted(blank)][:2] == [1, 1]


def test_empty_and_single(spark, empty):
    assert f.edited_fingerprints(empty).collect() == []
    one = f.edited_fingerprints(spark.createDataFrame([(5, "a b c d")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].near_edited in (0, 1)


def test_fingerprints_of_a_table(edge):
    rows = f.fingerprints(edge).collect()
    assert len(rows) == edge.count()
    assert all(r.n_shingles >= len(r.sketch) for r in rows)


def test_words_of_one_structure_have_hashes_of_their_own():
    """Thue-Morse words and their opposites collide in a polynomial modulo a power of two."""
    import pyarrow as pa

    from tidings.llm import textops as t

    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    words = [w for n in (64, 1024, 4096) for w in (word[:n], word[:n].translate(str.maketrans("ab", "ba")), word[:n][::-1] + "c")]
    words += ["ab", "ba", "a", "b", "aa", "aab", "é", "\u00e8"]
    [(_, data, offsets)] = list(t.slabs(pa.array([" ".join(words)])))
    starts, ends, _ = t.word_bounds(data, offsets)
    hashes = t.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(words)) == len(words)
    again = [int(t.word_hashes(d, *t.word_bounds(d, o)[:2])[0]) for w in words for _, d, o in t.slabs(pa.array([w.upper() if w.isascii() else w]))]
    assert again == hashes.tolist()
