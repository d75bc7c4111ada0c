from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF_DIR, edge_rows
from tidings.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.Encoder(MODEL)


def same_spans(model, library, text):
    """Spans agree with the library's; it lays the bytes of one character on the last of them."""
    ids = model.ids(text)
    assert ids == library.encode(text)
    starts, ends = model.spans(text, ids)
    found = library.encode(text, return_type="proto").pieces
    for p, start, end in zip(found, starts, ends, strict=True):
        if not library.is_byte(p.id):
            assert (p.begin, p.end) == (start, end)
    assert list(starts[1:]) == list(ends[:-1])
    if ids:
        assert starts[0] == 0 and ends[-1] == len(text.encode())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab, .▁\t\n  　é日😀<s>\x00", max_size=40))
def test_ids_and_spans(model, library, text):
    same_spans(model, library, text)


def test_given_texts(model, library, docs):
    for d in docs:
        same_spans(model, library, d.text)


# --- a model with a character map ---------------------------------------------------------------

def double_array(keys: dict[bytes, int]) -> bytes:
    """The compiled form of a few keys and their values: a trie laid out by trial."""
    units, used = {0: 0}, {0}

    def lay(node, entries):
        labels = sorted({k[:1] for k in entries}, key=lambda x: x or b"\0")
        codes = [k[0] if k else 0 for k in labels]
        base = 1
        while any(base ^ c in used for c in codes) or (node ^ base) >= 1 << 20:
            base += 1
        offset = node ^ base
        used.update(base ^ c for c in codes)
        units[node] |= offset << 10 | (256 if b"" in entries else 0)
        for c in codes:
            if c == 0:
                units[base] = entries[b""] | 1 << 31
            else:
                units[base ^ c] = c
        for c in codes:
            if c:
                lay(base ^ c, {k[1:]: v for k, v in entries.items() if k and k[0] == c})
    lay(0, keys)
    size = (max(units) // 256 + 1) * 256
    return b"".join(units.get(i, 0).to_bytes(4, "little") for i in range(size))


def with_map(rules: dict[str, str], prefix=1, squeeze=1) -> bytes:
    """The model with another normaliser: a later field replaces the earlier one."""
    values, at = b"", {}
    for key, value in rules.items():
        at[key.encode()] = len(values)
        values += value.encode() + b"\0"
    trie = double_array(at)
    blob = len(trie).to_bytes(4, "little") + trie + values

    def field(number, data):
        size, out = len(data), b""
        while size > 127:
            out += bytes([size & 127 | 128])
            size >>= 7
        return bytes([number << 3 | 2]) + out + bytes([size]) + data
    spec = field(2, blob) + bytes([3 << 3, prefix, 4 << 3, squeeze, 5 << 3, 1])
    with open(MODEL, "rb") as file:
        return file.read() + field(3, spec)


RULES = {"ﬁ": "fi", "é": "e", "ab": "x", "abc": "日本", "　": " ", "\t": " ", "­": "", "ＡＢ": "AB"}


@pytest.mark.parametrize("prefix, squeeze", [(1, 1), (1, 0), (0, 0), (0, 1)])
def test_longest_prefix_normalisation(tmp_path, prefix, squeeze):
    path = tmp_path / "m.model"
    path.write_bytes(with_map(RULES, prefix, squeeze))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    model = pieces.Encoder(str(path))

    @settings(max_examples=200, deadline=None)
    @given(st.text(alphabet="abc ﬁé　\t­ＡＢx日", max_size=20))
    def check(text):
        assert model.normaliser(text)[0].decode() == library.normalize(text)
        ids = model.ids(text)
        assert ids == library.encode(text)
        starts, ends = model.spans(text, ids)
        found = library.encode(text, return_type="proto").pieces
        for p, start, end in list(zip(found, starts, ends, strict=True))[1:-1]:
            if not library.is_byte(p.id):
                assert (p.begin, p.end) == (start, end)
    check()


# --- tables -------------------------------------------------------------------------------------

def expected(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out.append((i, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query(spark, docs, library):
    got = queries.op2_pieces(spark, SF_DIR).collect()
    assert sorted((tuple(r[:4]) for r in got), key=str) == expected(library, [(d.doc_id, d.text) for d in docs])
    size = {d.doc_id: len(d.text.encode()) for d in docs}
    assert all(r.covered_bytes == size[r.doc_id] for r in got)


def test_edge_rows(spark, folder, edge, empty, library):
    got = queries.op2_pieces(spark, folder).collect()
    assert sorted((tuple(r[:4]) for r in got), key=str) == expected(library, [r[:2] for r in edge_rows()])
    full = pieces.encode(edge, MODEL)
    texts = {r.doc_id: r.text for r in edge.collect()}
    for r in full.where("doc_id IS NOT NULL").collect():
        raw = (texts[r.doc_id] or "").encode()
        assert b"".join(raw[a:b] for a, b in zip(r.starts, r.ends)) == raw
    back = {r.doc_id: r.text for r in pieces.decode(full, MODEL).collect()}
    assert back[13] == library.decode(library.encode(texts[13]))
    assert pieces.encode(empty, MODEL).collect() == []
