"""An interpolated bigram model of the corpus, and the score of every text under it.

``p(w | v) = a[b] * c(v, w) / c(v) + u[b] * c(w) / N + z[b] / (V + 1)``, where ``b`` is the bucket
of the context's frequency ``c(v)``. The weights of each bucket come from expectation
maximisation on deleted counts: every training token is held out once, its own occurrence taken
off all counts.

How the counts meet the texts: each task cuts its texts into chunks and writes, for a chunk, its
tokens as numbers and its distinct words and word pairs with their counts, packed and sorted by
hash, one row for each range of hashes. Ranges are summed over all chunks, the totals go back to
the chunks that asked, in the order they sent. What is shuffled is thus distinct words and pairs
of a chunk, a few bytes each, and no word is a hot key.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.session import drop_path, drop_staged, stage

# Text bytes of one chunk and of one range of hashes.
CHUNK_BYTES = 14 << 20
RANGE_BYTES = 16 << 20
# Steps of an octave in which deleted probabilities are told apart for the weights, and rounds.
STEPS = 4
ROUNDS = 60
FOLDS, HELD_FOLD = 7, 2

TEXTS, WORDS, PAIRS = 0, 1, 2
PACKED = "chunk bigint, kind int, part int, ids array<bigint>, held array<boolean>, sizes array<int>, body binary, counts binary"
COUNTED = "chunk bigint, kind int, part int, body binary"
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)
JOINED = "ids array<bigint>, held array<boolean>, sizes array<int>, words binary, own binary, pairs binary"

# The end of a text, also the context of its first word.
_END = np.uint64(0x5851F42D4C957F2D)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray) -> bytes:
    """Integers by planes of equal bytes, compressed."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(body: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(body), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(dtype)


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """A hash for every token with the one before it; texts end with the end token."""
    before = np.empty_like(tokens)
    before[:1] = _END
    before[1:] = tokens[:-1]
    return t.mix(before * _ODD + tokens)


def _chunk_rows(chunk: int, texts: list[list], ranges: int) -> Iterator[tuple]:
    """The rows of one chunk from ``(ids, held, sizes, tokens)`` of its slabs."""
    tokens, lengths = np.concatenate([x[3] for x in texts]), [len(x[3]) for x in texts]
    for x in texts:
        x[3] = None  # held once
    train = np.repeat(~np.concatenate([x[1] for x in texts]), np.concatenate([x[2] for x in texts]))
    words, at = np.unique(tokens, return_inverse=True)
    # Frequent words get small numbers, which pack well.
    order = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words), dtype=np.uint32)
    numbers, done = rank[at], 0
    for part, ((ids, held, sizes, _), length) in enumerate(zip(texts, lengths)):
        body = pack(numbers[done : done + length])
        done += length
        yield chunk, TEXTS, part, ids, held.tolist(), sizes, body, None
    # The words themselves, to name the numbers again.
    yield chunk, TEXTS, -1, None, None, None, pack(words[order]), None
    counts = np.bincount(at, weights=train, minlength=len(words))
    yield from _range_rows(chunk, WORDS, words, counts, ranges)
    del at, numbers, rank, words
    pairs, at = np.unique(pair_hashes(tokens), return_inverse=True)
    counts = np.bincount(at, weights=train, minlength=len(pairs))
    yield from _range_rows(chunk, PAIRS, pairs, counts, ranges)


def _range_rows(chunk: int, kind: int, hashes: np.ndarray, counts: np.ndarray, ranges: int):
    part = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange(ranges + 1))
    for i in range(ranges):
        a, b = cuts[i], cuts[i + 1]
        if a < b:
            steps = np.diff(hashes[a:b], prepend=np.uint64(0))
            yield chunk, kind, i, None, None, None, pack(steps), pack(counts[a:b].astype(np.uint32))


_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(),
    "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_()),
}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, so that only one packed body at a time is copied."""
    for i in range(len(batch)):
        yield batch.slice(i, 1).to_pylist()[0]


def packed_chunks(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows of ``PACKED`` from ``doc_id, held, text``: tokens, words and pairs of every chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, texts, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            all_ids, all_held = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for first, data, offsets in t.slabs(batch.column(2)):
                starts, ends, word = t.word_bounds(data, offsets)
                hashes = t.word_hashes(data, starts, ends)
                n = len(word) - 1
                tokens = np.insert(hashes, word[1:], _END)
                here = slice(first, first + n)
                texts.append([all_ids[here], all_held[here].astype(bool), np.diff(word) + 1, tokens])
                size += len(data)
                if size >= CHUNK_BYTES:
                    for row in _chunk_rows(chunk, texts, ranges):
                        yield _batch([row], PACKED)
                    chunk, texts, size = chunk + 1, [], 0
        if texts:
            for row in _chunk_rows(chunk, texts, ranges):
                yield _batch([row], PACKED)
    return docs.select("doc_id", "held", "text").mapInArrow(run, PACKED)


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each (kind, part), totals in the order each chunk sent; and N and V for words (chunk -1)."""
    group, chunks, hashes, counts = None, [], [], []

    def result() -> pa.RecordBatch:
        kind, part = group
        sizes = np.cumsum([len(h) for h in hashes])[:-1]
        found, at = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(at, weights=np.concatenate(counts), minlength=len(found)).astype(np.uint64)
        rows = [(c, kind, part, pack(x)) for c, x in zip(chunks, np.split(totals[at], sizes))]
        if kind == WORDS:
            rows.append((-1, kind, part, struct.pack("<qq", int(totals.sum()), int((totals > 0).sum()))))
        return _batch(rows, COUNTED)

    for batch in batches:
        for row in _rows(batch):
            if (row["kind"], row["part"]) != group:
                if group is not None:
                    yield result()
                group, chunks, hashes, counts = (row["kind"], row["part"]), [], [], []
            chunks.append(row["chunk"])
            hashes.append(np.cumsum(unpack(row["body"], np.uint64), dtype=np.uint64))
            counts.append(unpack(row["counts"], np.uint32))
    if group is not None:
        yield result()


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training tokens and distinct words of each range."""
    for batch in batches:
        found = [struct.unpack("<qq", body) for body in batch.column(0).to_pylist()]
        n, v = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(v, pa.int64())], ["n", "v"])


def _join_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each chunk with the counts of their tokens and pairs, from rows ordered by chunk."""
    chunk, texts, words, counts = None, [], None, {WORDS: [], PAIRS: []}

    def result() -> Iterator[pa.RecordBatch]:
        numbers = [unpack(x[3], np.uint32) for x in texts]
        own = np.concatenate(counts[WORDS])
        rank = np.argsort(words, kind="stable")  # sorted words, as the counts are
        by_number = np.empty(len(words), np.uint64)
        by_number[rank] = own
        totals = np.concatenate(counts[PAIRS])
        counts.clear()
        _, at = np.unique(pair_hashes(words[np.concatenate(numbers)]), return_inverse=True)
        pairs, done = totals[at], 0
        del at, totals
        for (ids, held, sizes, _), part in zip(texts, numbers):
            here = slice(done, done + len(part))
            done += len(part)
            local, names = np.unique(part, return_inverse=True)
            yield _batch([(ids, held, sizes, pack(names.astype(np.uint32)), pack(by_number[local]),
                           pack(pairs[here]))], JOINED)

    for batch in batches:
        for row in _rows(batch):
            if row["chunk"] != chunk:
                if chunk is not None:
                    yield from result()
                chunk, texts, words, counts = row["chunk"], [], None, {WORDS: [], PAIRS: []}
            if row["kind"] != TEXTS:
                counts[row["kind"]].append(unpack(row["body"], np.uint64))
            elif row["part"] < 0:
                words = unpack(row["body"], np.uint64)
            else:
                texts.append((row["ids"], row["held"], row["sizes"], row["body"]))
    if chunk is not None:
        yield from result()


def _token_counts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and held marks of the texts; ``c(w)``, ``c(v)`` and ``c(v, w)`` of every token."""
    sizes = np.array(row["sizes"])
    own = unpack(row["own"], np.uint64).astype(np.int64)[unpack(row["words"], np.uint32)]
    first = np.cumsum(sizes) - sizes
    context = np.empty_like(own)
    context[1:] = own[:-1]
    context[first] = own[first + sizes - 1]  # the end token's count: one for every text
    return sizes, np.array(row["held"], bool), own, context, unpack(row["pairs"], np.uint64).astype(np.int64)


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """0 for no occurrence, then one bucket for every power of two."""
    return np.where(counts > 0, np.frexp(counts.astype(np.float64))[1], 0)


_FLOOR = -1000  # stands for a probability of nothing


def _steps(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.rint(STEPS * np.log2(np.maximum(p, 1e-300))), _FLOOR).astype(np.int64)


def deleted_events(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (bucket, pair probability, word probability) after deletion, and how often."""
    sizes, held, own, context, pairs = _token_counts(row)
    train = np.repeat(~held, sizes)
    own, context, pairs = own[train] - 1, context[train] - 1, pairs[train] - 1
    pair_p = np.where(context > 0, pairs / np.maximum(context, 1), 0.0)
    word_p = own / max(n - 1, 1)
    codes = (bucket_of(context) * 2048 + _steps(pair_p) + 1024) * 2048 + _steps(word_p) + 1024
    return np.unique(codes, return_counts=True)


def learn_weights(codes: np.ndarray, counts: np.ndarray, v: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (pair, word, uniform) of 65 buckets, by expectation maximisation on the events.

    All buckets start from equal weights; a bucket without events has the weights of the next
    lower one that has some. The uniform part never vanishes, so every score is finite.
    """
    weights = np.full((65, 3), 1 / 3)
    bucket = codes // (2048 * 2048)
    steps = np.stack([codes // 2048 % 2048 - 1024, codes % 2048 - 1024])
    p = np.where(steps == _FLOOR, 0.0, np.exp2(steps / STEPS))
    p = np.vstack([p, np.full((1, len(codes)), 1 / (v + 1))])
    last = weights[0]
    for b in range(65):
        here = bucket == b
        if here.any():
            w, events = np.full(3, 1 / 3), counts[here]
            for _ in range(rounds):
                share = w[:, None] * p[:, here]
                share /= share.sum(axis=0)
                w = (share * events).sum(axis=1) + [1e-9, 1e-9, 1e-3]
                w /= w.sum()
            last = w
        weights[b] = last
    # A context that never occurs has no pairs.
    weights[0] = [0.0, weights[0][1], weights[0][0] + weights[0][2]] if weights[0][1] else [0.0, 0.5, 0.5]
    return weights


def score_rows(row: dict, n: int, v: int, weights: np.ndarray) -> list[tuple]:
    """Rows of ``SCORES`` for the texts of one joined row."""
    sizes, held, own, context, pairs = _token_counts(row)
    text = np.repeat(np.arange(len(sizes)), sizes)
    base = np.log10((own + 1) / (n + (v + 1)))
    w = weights[bucket_of(context)]
    p = w[:, 0] * np.where(context > 0, pairs / np.maximum(context, 1), 0.0)
    p = p + w[:, 1] * own / max(n, 1) + w[:, 2] / (v + 1)
    known = np.bincount(text, own > 0, len(sizes)).astype(np.int64)
    bases = np.bincount(text, base, len(sizes))
    scores = np.bincount(text, np.log10(p), len(sizes))
    return list(zip(row["ids"], held.tolist(), sizes.tolist(), known.tolist(), [n] * len(sizes),
                    bases.tolist(), scores.tolist()))


def scored(docs: DataFrame, folds: int = FOLDS, held_fold: int = HELD_FOLD) -> DataFrame:
    """Rows of ``SCORES`` for every row of ``docs``; see the module for the model.

    A document is held out of training if the CRC-32 of its id as text leaves ``held_fold`` when
    divided by ``folds``; one without id is not. Tokens are the words and one end for each text,
    so an empty or null text has the end alone. Repeated rows count and are scored each. An empty
    table gives no rows; other columns are not read. Words and pairs are told apart by 64-bit
    hashes.

    To the driver come the number of training tokens and words, and the deleted events on a fixed
    grid of buckets and probability steps, whose size does not grow with the data.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_fold, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = t.shuffle_partitions(docs)
    ranges = max(parts, -(-size // RANGE_BYTES))

    packed = stage(packed_chunks(rows, ranges), "packed", partition_by=("kind",))
    grams = packed.where(F.col("kind") != TEXTS)
    counted = stage(
        grams.select("chunk", "kind", "part", "body", "counts")
        .repartition(max(parts, 2 * ranges), "kind", "part").sortWithinPartitions("kind", "part")
        .mapInArrow(_sum_ranges, COUNTED), "counted")
    for kind in (WORDS, PAIRS):
        drop_path(spark, f"{packed.staged_path}/kind={kind}")
    sums = counted.where("chunk = -1").select("body").mapInArrow(_totals, "n bigint, v bigint")
    n, v = (x or 0 for x in sums.agg(F.sum("n"), F.sum("v")).first())

    texts = packed.where(F.col("kind") == TEXTS).select("chunk", "kind", "part", "ids", "held", "sizes", "body")
    answers = counted.where("chunk >= 0").select(
        "chunk", "kind", "part", *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("ids", "held", "sizes")], "body")
    joined = stage(
        texts.unionByName(answers).repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "part")
        .mapInArrow(_join_counts, JOINED), "joined")
    drop_staged(packed, counted)

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                codes, counts = deleted_events(row, n)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    grid = joined.mapInArrow(events, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    codes = np.array([r["code"] for r in grid], np.int64)
    order = np.argsort(codes)
    weights = learn_weights(codes[order], np.array([r["n"] for r in grid], np.float64)[order], v)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield _batch(score_rows(row, n, v, weights), SCORES)
    return joined.mapInArrow(score, SCORES)
