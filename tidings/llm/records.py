"""Token ids as length-delimited binary records, with an index of their offsets.

A folder holds ``data/part-*.txt``, frames in ascending order of ids within and across files, and
``index``, one Parquet row a frame. A frame is

    length of the body (8 bytes) | masked CRC-32 of these 8 bytes (4) | body |
    masked CRC-32 of the body (4) | line feed

all little-endian; the line feed ends the record for Spark's text writer, which commits the files,
so lost executors leave no half files and any store Spark writes to will do. A body is: 1 byte that
tells whether there is an id, the id (8 bytes), 1 byte for the width of a token, the number of
tokens (4 bytes), the tokens.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidings.llm import textops as t

# Text bytes a file is made for; readers hold one file at a time.
FILE_BYTES = 24 << 20
# Remembered pieces of a worker, short ones and long ones, which bound its memory (some 60 bytes a
# short piece) and change no result.
CACHE_PIECES = 800_000
CACHE_LONG = 100_000

# Files in one group of the running sum over files.
FILE_GROUP = 1024

_HEAD, _SUM, _BODY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BqBI")
INDEX = (
    "file string, doc_id bigint, offset bigint, length bigint, before bigint, n_tokens bigint"
)
RECORDS = "file string, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"
CHOSEN = "at bigint, doc_id bigint, ids array<int>"


def masked(crc: int) -> int:
    """A checksum that may itself be stored in checksummed data."""
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    head = _HEAD.pack(len(body))
    return b"".join([head, _SUM.pack(masked(zlib.crc32(head))), body, _SUM.pack(masked(zlib.crc32(body))), b"\n"])


def body_of(doc_id: int | None, tokens: bytes, width: int) -> bytes:
    return _BODY.pack(doc_id is not None, doc_id or 0, width, len(tokens) // width) + tokens


def read_frame(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """Id, tokens and the offset behind the frame at ``at``; both checksums are compared."""
    head = bytes(data[at : at + 8])
    if len(head) < 8 or _SUM.unpack_from(data, at + 8)[0] != masked(zlib.crc32(head)):
        raise ValueError(f"broken length at offset {at}")
    size = _HEAD.unpack(head)[0]
    body = data[at + 12 : at + 12 + size]
    if len(body) < size or _SUM.unpack_from(data, at + 12 + size)[0] != masked(zlib.crc32(body)):
        raise ValueError(f"broken body at offset {at}")
    known, doc_id, width, count = _BODY.unpack_from(body)
    tokens = np.frombuffer(body, f"<u{width}", count, _BODY.size)
    return doc_id if known else None, tokens, at + 12 + size + 5


# Byte classes: white space, ASCII letters, and what makes a token of its own behind a letter (an
# apostrophe may not).
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
# The first bytes of white space beyond ASCII, with what may follow.
_FAR_BLANKS = {0xC2: (0x85, 0xA0), 0xE1: (0x9A, 0xA0), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class _Table:
    """Tokens of the pieces seen so far: those of entry ``i`` are ``lengths[i]`` from ``starts[i]`` on.

    Short pieces are found by a hash of their key, and the key is compared; long ones by their bytes.
    """

    def __init__(self, kind):
        self._kind = kind
        self.clear()

    def clear(self) -> None:
        self.long: dict[bytes, int] = {}
        self._hashes = np.zeros(0, np.uint64)  # in order
        self._of_hash = np.zeros(0, np.int64)
        self._keys = np.zeros((0, 2), np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, self._kind)

    def __len__(self) -> int:
        return len(self.starts)

    def find(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The entries of short pieces, -1 where there is none."""
        if not len(self._hashes):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        entry = self._of_hash[place]
        same = (self._hashes[place] == hashes) & (self._keys[entry, 0] == low) & (self._keys[entry, 1] == high)
        return np.where(same, entry, -1)

    def add(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, tokens: list[list[int]]) -> None:
        """Append entries, first those of the short pieces given by hash and key, then others."""
        count, short = len(self), len(hashes)
        keys = np.zeros((len(tokens), 2), np.uint64)
        keys[:short, 0], keys[:short, 1] = low, high
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter(chain.from_iterable(tokens), self._kind, int(lengths.sum()))
        self.starts = np.append(self.starts, len(self.tokens) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.tokens = np.append(self.tokens, flat)
        self._keys = np.append(self._keys, keys, axis=0)
        order = np.argsort(hashes)
        place = np.searchsorted(self._hashes, hashes[order])
        self._hashes = np.insert(self._hashes, place, hashes[order])
        self._of_hash = np.insert(self._of_hash, place, count + order)


class TokenBytes:
    """Tokens of whole texts as little-endian integers of the least width that holds all ids.

    The pattern of a byte-level model starts a new token at a space or line feed that stands alone
    between other characters, and at a full stop or the like behind a letter; a line feed that
    stands alone is a token itself. Merges stay inside tokens. So a slab of texts is cut at all
    these places at once, equal pieces are numbered by their bytes, and the library gets the pieces
    it has not had. A text with white space in a row is encoded as a whole, and so is a text with
    the content of an added token, which the library takes out before the pattern.
    """

    _RUN = re.compile(r"[\s\x1c-\x1f\x85]{2}")  # white space by any definition

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
        tokenizer = Tokenizer.from_file(path)
        self._tokenizer = tokenizer
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._kind = np.dtype(f"<u{self.width}")
        kind = type(tokenizer.pre_tokenizer).__name__
        self.by_piece = kind == "ByteLevel" and tokenizer.normalizer is None
        self._added = [x.content.encode() for x in tokenizer.get_added_tokens_decoder().values()]
        self._table = _Table(self._kind)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self.arrays(pa.array(texts, pa.large_string()))]

    def arrays(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The tokens of every text of a column."""
        for first, data, offsets in t.slabs(column):
            whole = self._whole(data, offsets)
            flat, ends = self._pieces(data, offsets, ~whole)
            texts = column.take(pa.array(first + np.flatnonzero(whole))).to_pylist() if whole.any() else []
            encoded = iter(self._encode(texts))
            start = 0
            for is_whole, end in zip(whole.tolist(), ends.tolist()):
                yield np.array(next(encoded), self._kind) if is_whole else flat[start:end]
                start = end

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts of a slab are encoded as a whole."""
        n = len(offsets) - 1
        if not self.by_piece:
            return np.ones(n, bool)
        out = np.zeros(n, bool)
        blank = _BLANK[data]
        at = np.flatnonzero(blank[1:] & blank[:-1])
        row = np.searchsorted(offsets, at, "right") - 1
        out[row[offsets[row + 1] > at + 1]] = True
        far = np.flatnonzero(data >= 0xC2)
        after = data[np.minimum(far + 1, len(data) - 1)] if len(data) else far
        maybe = np.zeros(len(far), bool)
        for lead, follow in _FAR_BLANKS.items():
            maybe |= (data[far] == lead) & np.isin(after, follow)
        raw = None
        rows = np.unique(np.searchsorted(offsets, far[maybe], "right") - 1)
        for i in rows[~out[rows]].tolist():
            out[i] = self._RUN.search(data[offsets[i] : offsets[i + 1]].tobytes().decode()) is not None
        for content in self._added:
            raw = data.tobytes() if raw is None else raw
            place = raw.find(content)
            while place >= 0:
                out[np.searchsorted(offsets, place, "right") - 1] = True
                place = raw.find(content, place + 1)
        return out

    def _pieces(self, data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the wanted texts, and where those of each text end."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            feed = data == 0x0A
            cut[:-1] = (data == 0x20) | feed
            cut[1:] |= feed
            cut[1:-1] |= _LETTER[data[:-1]] & _STOP[data[1:]]
        cut[offsets] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        # Empty texts share their place with the next one.
        row = np.searchsorted(offsets, starts, "right") - 1
        kept = wanted[row] & (starts < len(data))
        entry = self._entries(data, starts[kept], ends[kept])
        table = self._table
        lengths = table.lengths[entry]
        before = np.concatenate([[0], np.cumsum(lengths)])
        flat = table.tokens[np.repeat(table.starts[entry] - before[:-1], lengths) + np.arange(before[-1])]
        return flat, before[np.searchsorted(row[kept], np.arange(len(wanted)), "right")]

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entry of every piece, learned where there is none."""
        table = self._table
        if len(table) > CACHE_PIECES or len(table.long) > CACHE_LONG:
            table.clear()
        sizes = ends - starts
        # Up to 15 bytes and their number make a key, by which pieces are told apart exactly.
        padded = np.append(data, np.zeros(16, np.uint8))
        words = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
        low = words[starts] & _LOW_BYTES[np.minimum(sizes, 8)]
        high = words[starts + 8 * (sizes > 8)] & _LOW_BYTES[np.clip(sizes - 8, 0, 7)]
        high |= sizes.astype(np.uint64) << np.uint64(56)
        codes, hashes = pd.factorize(t.mix(low + t.mix(high)))
        head = np.empty(len(hashes), np.int64)  # the first piece of each hash
        head[codes[::-1]] = np.arange(len(codes))[::-1]
        first = head[codes]
        # Long pieces, and those whose hash is that of another, are told apart by their bytes.
        odd = (sizes > 15) | (low != low[first]) | (high != high[first])
        entry_of = table.find(hashes, low[head], high[head])
        new = np.flatnonzero((entry_of < 0) & ~odd[head])
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(starts[head[new]].tolist(), ends[head[new]].tolist())]
        entry_of[new] = len(table) + np.arange(len(new))
        odd_at = np.flatnonzero(odd)
        odd_entry = []
        for a, b in zip(starts[odd_at].tolist(), ends[odd_at].tolist()):
            piece = raw[a:b]
            if piece not in table.long:
                table.long[piece] = len(table) + len(texts)
                texts.append(piece)
            odd_entry.append(table.long[piece])
        if texts:
            tokens = self._encode([x.decode() for x in texts])
            table.add(hashes[new], low[head[new]], high[head[new]], tokens)
        entry = entry_of[codes]
        entry[odd_at] = odd_entry
        return entry


@lru_cache(maxsize=2)
def token_bytes(path: str) -> TokenBytes:
    """One tokenizer a worker process and file."""
    return TokenBytes(path)


def write_records(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int | None = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, append ``end_id`` to each, and write them in ascending order of ids.

    The texts are range-partitioned by id, which is the only shuffle; each task encodes, frames
    and writes one sorted range. A null text has the end id alone, a null id comes before all
    others, rows with equal ids are in the order of their texts. An empty table gives files
    without frames. Other columns are not read. ``tokenizer_file`` has to be readable under the
    same path on every executor.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(t.shuffle_partitions(docs), -(-size // FILE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(tokenizer_file)
        end = b"" if end_id is None else end_id.to_bytes(encode.width, "little")
        for batch in batches:
            frames, size = [], 0
            for i, tokens in zip(batch.column(0).to_pylist(), encode.arrays(batch.column(1))):
                # The writer adds the line feed.
                frames.append(frame(body_of(i, tokens.tobytes() + end, encode.width))[:-1])
                size += len(frames[-1])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])
                    frames, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])

    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    frames = ordered.mapInArrow(run, "value binary")
    frames.select(F.col("value").cast("string").alias("value")).write.text(f"{folder}/data")
    files = _files(docs.sparkSession, folder)
    files.mapInArrow(_index, INDEX).write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return found.select(name.alias("file"), "content").where(F.length("content") > 0)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of every frame, from lengths and ids alone."""
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
            while at < len(data):
                size = _HEAD.unpack_from(data, at)[0]
                known, doc_id, _, count = _BODY.unpack_from(data, at + 12)
                rows.append((name, doc_id if known else None, at, size + 17, before, count))
                at += size + 17
                before += count
            yield _batch(rows, INDEX)


_KINDS = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields])


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row a frame: file, id, offset, length, tokens, and ``before`` (tokens before it in the file)."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def with_start(rows: DataFrame, folder: str) -> DataFrame:
    """Add ``start``, the tokens of all frames before, to rows with ``file`` and ``before``.

    Across files the sums run over one row a file, in groups of files and over the groups. Spark
    chooses how the rows meet them.
    """
    files = read_index(rows.sparkSession, folder).groupBy("file").agg(F.sum("n_tokens").alias("_tokens"))
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int")
    numbered = files.select("file", "_tokens", number.alias("_number"), (number / FILE_GROUP).cast("int").alias("_group"))

    def before(of: str, window: WindowSpec) -> Column:
        return F.coalesce(F.sum(of).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = numbered.groupBy("_group").agg(F.sum("_tokens").alias("_sum"))
    groups = groups.select("_group", before("_sum", Window.orderBy("_group")).alias("_earlier"))
    inner = numbered.withColumn("_inner", before("_tokens", Window.partitionBy("_group").orderBy("_number")))
    bases = inner.join(groups, "_group").select("file", (F.col("_earlier") + F.col("_inner")).alias("_base"))
    return rows.join(bases, "file").withColumn("start", F.col("_base") + F.col("before")).drop("_base")


def read_records(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Every record read back with both checksums compared: ``file, doc_id, before, n_tokens``,
    the CRC-32 of its tokens as unsigned 32-bit integers, and the tokens (null without ``ids``).
    A folder of an empty table gives no rows; a broken record raises."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
                while at < len(data):
                    doc_id, tokens, at = read_frame(data, at)
                    crc = zlib.crc32(tokens.astype("<u4").tobytes())
                    kept = tokens.astype(np.int32) if ids else None
                    rows.append((name, doc_id, before, len(tokens), crc, kept))
                    before += len(tokens)
                    if len(rows) == 1000:
                        yield _batch(rows, RECORDS)
                        rows = []
                if rows:
                    yield _batch(rows, RECORDS)
    return _files(spark, folder).mapInArrow(run, RECORDS)


def read_chosen(spark: SparkSession, folder: str, chosen: DataFrame) -> DataFrame:
    """The records of some index rows (``file, offset`` and any order column ``at``), by offset.

    For shuffled reading: order or sample the index, and read those frames only. Frames that are
    not chosen are neither checked nor decoded. Rows come with ``at``, to be sorted by it. A row that
    is chosen twice comes twice; other columns of ``chosen`` are not read; none chosen, no rows.
    """
    wanted = chosen.groupBy("file").agg(F.collect_list(F.struct("offset", "at")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, rows in zip(batch.column(0), batch.column(1).to_pylist()):
                data = memoryview(content.as_buffer())
                found = [(r["at"], *read_frame(data, r["offset"])[:2]) for r in rows]
                yield _batch([(at, d, x.astype(np.int32)) for at, d, x in found], CHOSEN)

    files = _files(spark, folder).join(wanted, "file").select("content", "wanted")
    return files.mapInArrow(run, CHOSEN)
