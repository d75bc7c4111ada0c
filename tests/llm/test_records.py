from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import SF_DIR, edge_rows
from tidings.llm import queries, records

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1,' \t\n\r\x1c\x85\xa0 é日😀<|endoftext|>s", max_size=40))
def test_chunks_change_no_token(library, text):
    got = np.frombuffer(records.token_bytes(PATH)([text])[0], "<u2").tolist()
    assert got == library(text)


def test_given_texts(library, docs):
    for d in docs:
        assert np.frombuffer(records.token_bytes(PATH)([d.text])[0], "<u2").tolist() == library(d.text)


def expected(library, rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library(text), 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def by_start(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_query(spark, docs, library):
    got = queries.op3_records(spark, SF_DIR).collect()
    assert by_start(got) == expected(library, [(d.doc_id, d.text) for d in docs])


def test_edge_rows(spark, folder, library):
    got = queries.op3_records(spark, folder).collect()
    assert by_start(got) == expected(library, [r[:2] for r in edge_rows()])


def test_files_index_and_shuffled_reading(spark, edge, empty, library, tmp_path):
    path = str(tmp_path / "r")
    records.write_records(edge, path, PATH)
    back = records.read_records(spark, path).collect()
    texts = {(r.doc_id, r.text or "") for r in edge.collect()}
    assert {(r.doc_id, tuple(r.ids)) for r in back} == {(i, (*library(x), 0)) for i, x in texts}
    index = records.read_index(spark, path)
    assert index.count() == edge.count()
    chosen = index.where("doc_id > 8").withColumn("at", F.xxhash64("doc_id"))
    got = records.read_chosen(spark, path, chosen.select("file", "offset", "at")).orderBy("at").collect()
    assert [r.at for r in got] == sorted(r.at for r in chosen.collect())
    assert {(r.doc_id, tuple(r.ids)) for r in got} == {(i, (*library(x), 0)) for i, x in texts if i and i > 8}
    twice = chosen.where("doc_id IN (10, 12)").select("file", "offset", "at")
    got = records.read_chosen(spark, path, twice.unionByName(twice)).collect()
    assert len(got) == 4 and len({(r.at, tuple(r.ids)) for r in got}) == 2
    assert records.read_chosen(spark, path, twice.limit(0)).collect() == []
    records.write_records(empty, str(tmp_path / "none"), PATH)
    assert records.with_start(records.read_records(spark, str(tmp_path / "none")), str(tmp_path / "none")).count() == 0


def test_a_changed_byte_is_found(spark, tmp_path):
    path = tmp_path / "r"
    docs = spark.createDataFrame([(1, "some text here"), (2, "more")], "doc_id bigint, text string")
    records.write_records(docs.coalesce(1), str(path), PATH)
    for file in (path / "data").glob("part-*"):
        data = bytearray(file.read_bytes())
        if data:
            data[20] ^= 1
            file.write_bytes(bytes(data))
    for crc in (path / "data").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(PythonException, match="broken body"):
        records.read_records(spark, str(path)).collect()


def test_frames():
    body = records.body_of(None, b"\x01\x00\x02\x00", 2)
    doc_id, tokens, end = records.read_frame(memoryview(records.frame(body)), 0)
    assert doc_id is None and tokens.tolist() == [1, 2] and end == len(records.frame(body))


PIECES = st.sampled_from([
    "<|endoftext|>", "a", "word.", "don't", "x,'s", "...", ",", "-", "'", "'re", " ", "  ", "\n", "\t", "é", "é,", "\x85", "\xa0",
    " ", "　", "“", "日本", "、", "😀", "12", "12.", "\x00", "fifteen bytes..", "sixteen letters!", "a\x00", "A" * 40,
])


@settings(max_examples=600, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), max_size=6))
def test_texts_of_a_slab_do_not_mix(library, texts):
    got = [np.frombuffer(x, "<u2").tolist() for x in records.token_bytes(PATH)(texts)]
    assert got == [library(x) for x in texts]


@pytest.mark.parametrize("same", [True, False])
def test_pieces_of_one_hash_are_told_apart(monkeypatch, library, docs, same):
    """Even where all hashes are equal, or few differ."""
    monkeypatch.setattr(records.t, "mix", lambda x: x * np.uint64(0) if same else x % np.uint64(7))
    encode = records.TokenBytes(PATH)
    for _ in range(2):
        for d in docs[:30]:
            assert np.frombuffer(encode([d.text])[0], "<u2").tolist() == library(d.text)


def test_a_full_table_starts_anew(monkeypatch, library, docs):
    monkeypatch.setattr(records, "CACHE_PIECES", 50)
    monkeypatch.setattr(records, "CACHE_LONG", 3)
    encode = records.TokenBytes(PATH)
    for d in docs[:60]:
        assert np.frombuffer(encode([d.text])[0], "<u2").tolist() == library(d.text)
    assert len(encode._table) < 60_000


def test_starts_over_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "FILE_GROUP", 3)
    monkeypatch.setattr(records, "FILE_BYTES", 200)
    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('ab ', cast(id % 7 AS int)) AS text")
    records.write_records(docs, str(tmp_path / "r"), PATH)
    rows = records.with_start(records.read_records(spark, str(tmp_path / "r")), str(tmp_path / "r")).collect()
    assert len({r.file for r in rows}) > 8
    done = 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        assert r.start == done
        done += r.n_tokens
