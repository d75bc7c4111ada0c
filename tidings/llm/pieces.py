"""SentencePiece encoding with the place of every piece in the original text, and decoding.

A text is normalised here, by the longest match in the model's compiled character map, and every
normalised byte remembers the original byte it came from. The library gives the pieces; their
lengths on the normalised text are then projected to spans of the original bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
_MARK = SPACE_MARK.encode()
# Cached chunks of a worker, and the longest one kept, which bound a worker's memory (some 50 MB, held
# as long as the worker lives); when full the cache starts anew. Neither changes a result.
CACHE_CHUNKS = 120_000
CACHED_CHARS = 64

ENCODED = (
    "doc_id bigint, ids array<int>, starts array<int>, ends array<int>, decoded string"
)
DIGESTS = (
    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
    "spans_sha256 string, covered_bytes bigint"
)


# --- the model file ---------------------------------------------------------------------------

def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a serialised message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class Rules:
    """How a model normalises: its character map and three switches."""

    units: np.ndarray  # the double array that holds the map's keys
    values: bytes  # the replacements, each ended by a zero byte
    dummy_prefix: bool = True
    squeeze: bool = True  # drop leading and trailing spaces, merge runs
    escape: bool = True  # write a space as the space mark

    @classmethod
    def of(cls, model: bytes) -> Rules:
        # Field numbers of the model format: 3 normaliser; in it 2 map, 3 prefix, 4 squeeze, 5 escape.
        found = {2: b"", 3: 1, 4: 1, 5: 1}
        for number, value in _fields(model):
            if number == 3:
                found |= dict(_fields(value))
        blob = found[2]
        size = int.from_bytes(blob[:4], "little") if blob else 0
        units = np.frombuffer(blob[4 : 4 + size], "<u4") if blob else np.zeros(0, "<u4")
        return cls(units, blob[4 + size :], bool(found[3]), bool(found[4]), bool(found[5]))

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``data`` has at ``at``."""
        units, best = self.units, None
        node = _child_base(int(units[0]))
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != data[i]:
                break
            leaf = unit >> 8 & 1
            node ^= _child_base(unit)
            if leaf:
                start = int(units[node]) & 0x7FFFFFFF
                best = i + 1 - at, self.values[start : self.values.index(b"\0", start)]
        return best

    def first_bytes(self) -> bytes:
        """The bytes a key can begin with."""
        if not len(self.units):
            return b""
        root = _child_base(int(self.units[0]))
        return bytes(
            b for b in range(1, 256)
            if root ^ b < len(self.units) and int(self.units[root ^ b]) & 0x800000FF == b
        )


def _child_base(unit: int) -> int:
    """Where the children of a node lie, relative to it (the double array's layout)."""
    return (unit >> 10) << ((unit & 512) >> 6)


# --- normalisation ----------------------------------------------------------------------------

class Normaliser:
    """Normalised text with, for each of its bytes and its end, the original byte position."""

    def __init__(self, rules: Rules):
        self.rules = rules
        first = rules.first_bytes()
        self._candidates = re.compile(b"[" + re.escape(first) + b"]") if first else None

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The character map applied from left to right, longest key first."""
        if self._candidates is None:
            return data, np.arange(len(data) + 1)
        out, origin, done = [], [], 0
        found = self._candidates.search(data)
        while found:
            at = found.start()
            hit = self.rules.longest(data, at)
            # Keys begin and end between characters; without one, the whole character is copied.
            if hit is None:
                at += 1
                while at < len(data) and data[at] & 0xC0 == 0x80:
                    at += 1
                found = self._candidates.search(data, at)
                continue
            out += [data[done:at], hit[1]]
            origin += [np.arange(done, at), np.full(len(hit[1]), at)]
            done = at + hit[0]
            found = self._candidates.search(data, done)
        out.append(data[done:])
        origin.append(np.arange(done, len(data) + 1))
        return b"".join(out), np.concatenate(origin)

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        rules = self.rules
        data, origin = self._mapped(text.encode())
        raw = np.frombuffer(data, np.uint8)
        if rules.squeeze:
            space = raw == 0x20
            keep = ~space
            # Of a run the first space stays, except at both ends of the text.
            keep[1:] |= space[1:] & ~space[:-1]
            solid = np.flatnonzero(~space)
            if len(solid):
                keep[: solid[0]] = False
                keep[solid[-1] + 1 :] = False
            else:
                keep[:] = False
            end = origin[solid[-1] + 1] if len(solid) else origin[-1]
            raw, origin = raw[keep], np.append(origin[:-1][keep], end)
        if not len(raw) and (rules.squeeze or not text):
            return b"", origin[-1:]
        mark = np.frombuffer(_MARK if rules.escape else b" ", np.uint8)
        if rules.dummy_prefix:
            raw = np.append(np.uint8(0x20), raw)
            origin = np.append(origin[0], origin)
        sizes = np.where(raw == 0x20, len(mark), 1)
        ends = np.cumsum(sizes)
        out = np.repeat(raw, sizes)
        if len(mark) > 1:
            spaces = ends[raw == 0x20] - len(mark)
            for i, byte in enumerate(mark):
                out[spaces + i] = byte
        return out.tobytes(), np.append(np.repeat(origin[:-1], sizes), origin[-1])


# --- encoding ---------------------------------------------------------------------------------

class _Chunks(dict):
    """Ids of the chunks seen so far."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = tuple(self.encode(chunk))
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """A SentencePiece model: ids and spans of texts, and texts of ids."""

    def __init__(self, model_file: str):
        with open(model_file, "rb") as file:
            model = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normaliser = Normaliser(Rules.of(model))
        size = self.library.vocab_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.decimal = [str(i) for i in range(size)]
        self.lengths = np.array(
            [1 if self.library.is_byte(i) else len(p.encode()) for i, p in enumerate(names)])
        self.lengths[self.library.unk_id()] = -1
        rules = self.normaliser.rules
        # No piece goes on behind a space mark that follows other characters, so a text can be
        # encoded from one such mark to the next: what merges on one side cannot reach the other.
        self._by_chunk = (
            not len(rules.units) and rules.dummy_prefix and rules.escape and not rules.squeeze
            and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names)
        )
        self._chunks = _Chunks(self.library.encode)
        self._split = re.compile(f"(?<=[^ {SPACE_MARK}]) (?=.)", re.DOTALL).split

    def ids(self, text: str) -> list[int]:
        """Ids of a text, without begin and end, as the library gives them."""
        if not self._by_chunk:
            return self.library.encode(text)
        return list(chain.from_iterable(map(self._chunks.__getitem__, self._split(text))))

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece in the original bytes.

        The spans follow one another without gaps. Of several pieces that stand for one replaced
        character the last has its span and the others are empty; so is a piece made of added
        characters alone (the space put before a text).
        """
        data, origin = self.normaliser(text)
        sizes = self.lengths[ids] if len(ids) else np.zeros(0, np.int64)
        if (sizes < 0).any():  # unknown pieces: the library tells their text
            texts = self.library.encode(text, out_type=str)
            sizes = np.where(sizes < 0, [len(p.encode()) for p in texts], sizes)
        ends = np.cumsum(sizes)
        if len(data) != (ends[-1] if len(ends) else 0):
            raise ValueError("pieces and normalised text differ in length")
        return origin[ends - sizes], origin[ends]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def encoder(model_file: str) -> Encoder:
    """One encoder a worker process and model."""
    return Encoder(model_file)


def _texts(batches: Iterator[pa.RecordBatch], step: int = 256):
    for batch in batches:
        for at in range(0, len(batch), step):
            part = batch.slice(at, step)
            yield part.column(0), [x or "" for x in part.column(1).to_pylist()]


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, ids, starts, ends, decoded`` of every text; no shuffle, rows are independent.

    Whole texts are encoded; a null or empty text has no pieces. Repeated rows and null ids stay
    as they are, other columns are not read. Starts and ends count bytes of the original text.
    ``model_file`` has to be readable under the same path on every executor.
    """
    def run(batches):
        model = encoder(model_file)
        for ids_column, texts in _texts(batches):
            ids = [model.ids(x) for x in texts]
            spans = [model.spans(x, y) for x, y in zip(texts, ids)]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids_column, pa.array(ids, ints), pa.array([s for s, _ in spans], ints),
                 pa.array([e for _, e in spans], ints), pa.array(model.decode(ids), pa.string())],
                ["doc_id", "ids", "starts", "ends", "decoded"])
    return _narrow(docs).mapInArrow(run, ENCODED)


def encode_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """As ``encode``, with counts and digests in place of the arrays, made where the arrays are.

    ``spans_sha256`` is over starts and ends as little-endian 32-bit integers, ``covered_bytes``
    the sum of the lengths of the spans.
    """
    def run(batches):
        model = encoder(model_file)
        for ids_column, texts in _texts(batches):
            ids = [model.ids(x) for x in texts]
            decoded = model.decode(ids)
            rows = [[], [], [], [], []]
            for text, one, back in zip(texts, ids, decoded):
                starts, ends = model.spans(text, one)
                joined = ",".join(map(model.decimal.__getitem__, one))
                rows[0].append(len(one))
                rows[1].append(sha256(joined.encode()).hexdigest())
                rows[2].append(sha256(back.encode()).hexdigest())
                rows[3].append(sha256(np.concatenate([starts, ends]).astype("<i4").tobytes()).hexdigest())
                rows[4].append(int((ends - starts).sum()))
            kinds = [pa.int64(), *[pa.string()] * 3, pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [ids_column, *[pa.array(r, k) for r, k in zip(rows, kinds)]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "covered_bytes"])
    return _narrow(docs).mapInArrow(run, DIGESTS)


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give the empty text."""
    def run(batches):
        model = encoder(model_file)
        for batch in batches:
            ids = [x or [] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.decode(ids), pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
