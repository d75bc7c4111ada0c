"""Token counts against the libraries."""

from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import SF_DIR, edge_rows
from tidings.llm import counts, queries

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
PIECES = st.sampled_from([
    "<|endoftext|>", "<|endof", "text|>", "<s>", "</s>", "<0x0A>", "a", "word.", "don't", ",", " ", "  ", "\n", "\r\n", "é",
    "Σ", "é", " ́", "▁", "▁▁", "᠎", "​", "﻿", "\x85", "\x1c", "\xa0", "日本", "😀", "12", "'s",
])


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(processor.encode(text))
    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def libraries():
    return {name: library(name) for name in FILES}


@pytest.mark.parametrize("name", FILES)
def test_every_given_tokenizer_is_cut(name):
    assert counts.counter(public_tokenizers.path(name)).boundaries is not None


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=500, deadline=None)
@given(text=st.lists(PIECES, max_size=14).map("".join))
def test_counts_are_those_of_the_library(libraries, name, text):
    assert counts.counter(public_tokenizers.path(name))([text]) == [libraries[name](text)]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(text=st.lists(PIECES, min_size=20, max_size=80).map("".join), size=st.integers(1, 20))
def test_parts_of_long_texts(libraries, name, text, size):
    count = counts.counter(public_tokenizers.path(name))
    parts = list(count.boundaries.parts(text, size))
    assert sum(count._words([x])[0] for x in parts) == libraries[name](text)
    glue = "" if count.boundaries.lead else " "
    assert glue.join(parts) == text


@pytest.mark.parametrize("name", FILES)
def test_given_and_long_texts(libraries, docs, name, monkeypatch):
    monkeypatch.setattr(counts, "BATCH_BYTES", 2000)
    monkeypatch.setattr(counts, "KEPT_WORDS", 300)
    texts = [d.text or "" for d in docs] + ["x" * 5000, "long  " * 900 + "<|endoftext|> tail"]
    count = counts.counter(public_tokenizers.path(name))
    assert count(texts) == [libraries[name](x) for x in texts]
    assert all(len(x) <= counts.KEPT_CHARS for known in count._known.values() for x in known)


def test_batches_are_balanced_by_bytes(monkeypatch):
    import numpy as np

    monkeypatch.setattr(counts, "BATCH_BYTES", 10)
    sizes = np.array([4, 4, 4, 0, 30, 1, 9, 1])
    assert list(counts.balanced(sizes)) == [(0, 2), (2, 4), (4, 5), (5, 7), (7, 8)]
    assert list(counts.balanced(sizes[:0])) == []


def test_tokenizers_of_unknown_pattern_are_not_cut(tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    from tokenizers import normalizers, pre_tokenizers

    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.ByteLevel(use_regex=False)])
    tokenizer.save(str(tmp_path / "a.json"))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tokenizer.normalizer = normalizers.NFC()
    tokenizer.save(str(tmp_path / "b.json"))
    for name in ("a.json", "b.json"):
        count = counts.counter(str(tmp_path / name))
        expected = Tokenizer.from_file(str(tmp_path / name))
        assert count.boundaries is None
        assert count(["a b  c", ""]) == [len(expected.encode("a b  c").ids), 0]


def expected(rows, count):
    out = [(i, len((x or "").encode()), count(x or "")) for i, x in rows]
    return sorted(str((*r, r[2] > 512)) for r in out)


def test_query(spark, docs, libraries):
    got = queries.op11_token_counts(spark, SF_DIR)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert sorted(str(tuple(r)) for r in got.collect()) == expected([(d.doc_id, d.text) for d in docs], libraries[FILES[0]])


@pytest.mark.parametrize("name", FILES)
def test_edge_rows(edge, empty, libraries, name):
    path = public_tokenizers.path(name)
    got = counts.token_counts(edge, path).collect()
    assert sorted(str(tuple(r)) for r in got) == expected([r[:2] for r in edge_rows()], libraries[name])
    assert counts.token_counts(empty, path).collect() == []
