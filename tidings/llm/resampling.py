"""Importance resampling towards a target set, on hashed runs of words.

A text is one pass over its bytes: a 256-byte table lower-cases A-Z and blanks every separator,
``bytes.split`` gives the words, and the checksum of a run of words is that of the run without its
last word, carried on. Two whole passes over the texts: one counts the buckets, one weighs every
document by the gains of its buckets. Between them only the counts of the buckets reach the driver,
whose number is a parameter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.operators.ranking import rank_rows
from tidings.session import drop_staged, stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# Bytes of a text taken at a time, which bounds the lists of a task.
CHUNK_BYTES = 1 << 20
RESULT = "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint"

# Digits, lower-case letters and all bytes from 128 stay, A-Z become a-z, the rest separates.
TABLE = bytes(
    c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def features(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """``(words, buckets of the features that end in them)`` of a translated text, chunk by chunk."""
    last: list[bytes] = []
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK_BYTES:
            cut = data.find(b" ", at + CHUNK_BYTES)
            end = cut if cut >= 0 else end
        new = data[at:end].split()
        at = end
        if not new:
            continue
        words = last + new
        spaced = [b" " + w for w in words]
        one = list(map(crc32, words))
        two = list(map(crc32, spaced[1:], one))
        three = map(crc32, spaced[2:], two)
        # Runs that end before the new words were in an earlier chunk.
        old = len(last)
        found = chain(one[old:], two[max(old - 1, 0) :], three)
        yield len(new), np.fromiter(found, np.int64) % BUCKETS
        last = words[-2:]


def _translated(column: pa.Array) -> Iterator[bytes]:
    for _, data, offsets in t.slabs(column):
        lowered = data.tobytes().translate(TABLE)
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            yield lowered[start:end]


def bucket_counts(texts: DataFrame) -> DataFrame:
    """``target, bucket, n`` of ``target, text``: at most one row a task, set and bucket is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bool, Counter] = {False: Counter(), True: Counter()}
        for batch in batches:
            for target, text in zip(batch.column(0).to_pylist(), _translated(batch.column(1))):
                for _, buckets in features(text):
                    counts[target].update(buckets.tolist())
        for target, found in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([target] * len(found), pa.bool_()), pa.array(list(found), pa.int32()),
                 pa.array(list(found.values()), pa.int64())], ["target", "bucket", "n"])

    rows = texts.select("target", "text").mapInArrow(run, "target boolean, bucket int, n bigint")
    return rows.groupBy("target", "bucket").agg(F.sum("n").alias("n"))


def gains(counts: dict[bool, dict[int, int]]) -> np.ndarray:
    """Whole thousandths of the log ratio of a bucket's share in the target and in the source."""
    source, target = counts[False], counts[True]
    all_source, all_target = float(sum(source.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1) * all_source / ((source.get(b, 0) + 1) * all_target)))
        for b in range(BUCKETS)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """The random part of a score, from the id alone; a null id is written as nothing."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every document with ``n_features, weight, score`` and, where it is drawn, ``rank``.

    Of the N documents with at least ``least_words`` words the ``percent * N // 100`` with the
    highest scores are drawn, ties to the smaller id. Null texts count as empty, a text without
    words has no features and weight 0. Null ids come before all others; repeated rows count each
    time, and rows with equal ids and texts share their score and may be drawn side by side. An
    empty target or an empty table of documents is allowed. Other columns are not read. Runs jobs.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    both = rows.select(F.lit(False).alias("target"), "text").unionByName(
        target.select(F.lit(True).alias("target"), "text"))
    counts: dict[bool, dict[int, int]] = {False: {}, True: {}}
    for row in bucket_counts(both).collect():  # at most two rows a bucket
        counts[row.target][row.bucket] = row.n
    gain = gains(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for doc_id, text in zip(ids, _translated(batch.column(1))):
                n_words = n_features = weight = 0
                for words, buckets in features(text):
                    n_words += words
                    n_features += len(buckets)
                    weight += int(gain[buckets].sum())
                out.append((doc_id, n_features, weight, weight + noise(doc_id), int(n_words >= least_words)))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "n_features", "weight", "score", "eligible"])

    weighed = stage(
        rows.mapInArrow(run, "doc_id bigint, n_features bigint, weight bigint, score bigint, eligible bigint"),
        "weighed")
    # Equal rows are told apart, so that a hot one is spread over the ranges.
    told = weighed.withColumn("_row", F.monotonically_increasing_id())
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("_row")]
    ranked = rank_rows(told, *order, name="_rank", total_of="eligible", stored=True)
    drawn = (F.col("eligible") == 1) & (F.col("_rank") <= F.expr(f"total * {int(percent)} div 100"))
    drop_staged(weighed)
    return ranked.select(
        "doc_id", "n_features", "weight", "score", F.when(drawn, F.col("_rank")).cast("bigint").alias("rank"))
