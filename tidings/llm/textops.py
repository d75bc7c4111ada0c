"""Words and shingles of many texts at once, on the bytes of an Arrow column.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed and
carriage return; A-Z count as a-z. A shingle is five consecutive words; a text of one to four words
has its whole sequence as one shingle, a text without words has none. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

# Texts are taken in slabs of about this many bytes, which bounds the arrays of a task; a single
# longer text is a slab of its own.
SLAB_BYTES = 2 << 20
HASHED_WORDS = 16_384

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Fixed odd multipliers: one for lengths and one for each place in a shingle.
_BASE = 0x9E3779B97F4A7C15
_PLACES = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
     0xE7037ED1A0B428DB], np.uint64)

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slabs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows; null counts as the empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLAB_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of each text's first word (one more at the end)."""
    solid = ~_SPACE[data]
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: the sum of a mixed value for each byte and its place in the word.

    The values are not related from place to place or byte to byte, so no family of words collides
    by its structure, as it would in a polynomial modulo a power of two.
    """
    out = np.empty(len(starts), np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = _LOWER[data[~_SPACE[data]]]
    # Some thousand words at a time, which bounds what is held for every byte.
    for at in range(0, len(starts), HASHED_WORDS):
        some = slice(at, at + HASHED_WORDS)
        begin, local = first[at], first[some] - first[at]
        stop = begin + local[-1] + sizes[some][-1]
        place = np.arange(1, stop - begin + 1, dtype=np.uint64) - np.repeat(local, sizes[some]).astype(np.uint64)
        out[some] = np.add.reduceat(mix(letters[begin:stop] + place * np.uint64(256)), local)
    return mix(out + sizes.astype(np.uint64) * np.uint64(_BASE))


def shingle_hashes(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order, and the index of each text's first one."""
    counts = np.diff(first)
    sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    start = first[:-1][owner] + np.arange(at[-1]) - at[:-1][owner]
    length = np.minimum(counts[owner], SHINGLE)
    total = length.astype(np.uint64) * np.uint64(_BASE)
    for place in range(SHINGLE):
        there = length > place
        index = np.where(there, start + place, 0)
        if len(words):
            total += np.where(there, words[index] * _PLACES[place], np.uint64(0))
    return mix(total), at


def shingles(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle hashes of every text of the column, in order, with repeats."""
    for _, data, offsets in slabs(column):
        starts, ends, first = word_bounds(data, offsets)
        hashes, at = shingle_hashes(word_hashes(data, starts, ends), first)
        for i in range(len(at) - 1):
            yield hashes[at[i] : at[i + 1]]


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def id_or_lowest(c: str | Column = "doc_id") -> Column:
    """The id for sorting, a null id before all others."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(-(1 << 63)).cast("bigint"))
