"""Threshold-scaled sketches: all shingle hashes below a fixed fraction of the hash range.

What a text keeps depends on its shingles alone, so the sketch of a union is the union of the
sketches, and containment can be estimated between texts of very different lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import textops as t

# One hash in so many is kept; by measured error, since many texts have under 200 shingles.
SCALE = 2

OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, "
    "contained_in_edited double, contained_in_next double"
)


def sketch(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct hashes below ``2**64 / scale``; the least hash where none is below.

    The least hash keeps the sketch of a short text from being empty. It is dropped by ``merge``
    as soon as the other side has hashes below the threshold, so merging stays exact.
    """
    low = hashes[hashes < np.uint64((1 << 64) // scale)]
    return np.unique(low) if len(low) else hashes[:0] if not len(hashes) else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both texts' shingles together, from their sketches alone."""
    return sketch(np.concatenate([a, b]), scale)


def to_text(kept: np.ndarray) -> str:
    """A sketch as hexadecimal digits, 16 a hash, in ascending order."""
    return kept.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Estimated Jaccard similarity, and the share of ``a`` contained in ``b``.

    Two empty sketches (texts without words) are alike; an empty and another one are not.
    """
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both), both / len(a)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 scale: int = SCALE) -> DataFrame:
    """``id, n_shingles, sketch array<bigint>`` for every row; no shuffle.

    A null text counts as empty; empty texts and texts without words have an empty sketch.
    Hashes are stored as signed integers with the same bits. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept = [], []
            for hashes in t.shingles(batch.column(1)):
                counts.append(len(np.unique(hashes)))
                kept.append(sketch(hashes, scale).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(kept, pa.list_(pa.int64()))],
                ["id", "n_shingles", "sketch"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, n_shingles bigint, sketch array<bigint>")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows of ``_part, _last, doc_id, text``, in the order of ids inside each partition.

    Rows are dealt into ranges of ids of about equal numbers, one a partition. The first row of
    each range is repeated at the end of the range before it (``_last`` = 1), the first of all at
    the end of the last, so every row finds its successor behind it. The texts are shuffled once.
    Only the bounds of the ranges and the ids of their first rows come to the driver, one a
    partition. A null id comes before all others; rows with equal ids follow by the hash of their
    text.
    """
    spark, parts = docs.sparkSession, t.shuffle_partitions(docs)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("_at", t.id_or_lowest("doc_id"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = rows.agg(F.percentile_approx("_at", shares, 10_000)).first()[0] or []
    bounds = np.unique(np.array(bounds, np.int64)) if parts > 1 else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def part_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(), "right").astype(np.int32))

    rows = rows.withColumn("_part", part_of("_at"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    heads = rows.groupBy("_part").agg(F.min(F.struct("_at", "_hash")).alias("_head"))
    found = sorted((r["_part"], r["_head"]["_at"], r["_head"]["_hash"]) for r in heads.collect())
    before = [(found[i - 1][0], at, h, part) for i, (part, at, h) in enumerate(found)]
    firsts = spark.createDataFrame(before, "_to int, _at bigint, _hash bigint, _part int")
    # One row a partition, so small enough to be sent to all tasks.
    tails = (
        rows.join(F.broadcast(firsts), ["_part", "_at", "_hash"])
        .dropDuplicates(["_part"])
        .select(F.col("_to").alias("_part"), F.lit(1).alias("_last"), "_at", "_hash", "doc_id", "text")
    )
    own = rows.select("_part", F.lit(0).alias("_last"), "_at", "_hash", "doc_id", "text")
    return (
        own.unionByName(tails)
        .repartitionById(parts, F.col("_part"))
        .sortWithinPartitions("_part", "_last", "_at", "_hash")
        .select("_part", "_last", "doc_id", "text")
    )


def _compare(ids: list, texts: list[str], nexts: list[str], scale: int) -> pa.RecordBatch:
    """The result rows of texts whose successors are known."""
    from hashlib import sha256

    edited = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(texts, nexts)]
    own = [sketch(h, scale) for h in t.shingles(pa.array([*texts, nexts[-1]], pa.large_string()))]
    new = [sketch(h, scale) for h in t.shingles(pa.array(edited, pa.large_string()))]
    columns = [[] for _ in range(9)]
    for i, doc_id in enumerate(ids):
        to_edited, to_next = likeness(own[i], new[i]), likeness(own[i], own[i + 1])
        row = (doc_id, len(texts[i]), sha256(edited[i].encode()).hexdigest(), to_text(own[i]),
               to_text(new[i]), to_edited[0], to_next[0], to_edited[1], to_next[1])
        for column, value in zip(columns, row):
            column.append(value)
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    names = [c.split()[0] for c in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names)


def edited_fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    The edited form has the last half of the code points replaced by as many first ones (or all)
    of the next document. Null texts are empty; repeated rows follow one another; an empty table
    gives no rows; other columns are not read. Runs two small jobs when called.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, which waits for its successor
        for batch in batches:
            parts, lasts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            all_ids, all_texts = batch.column(2).to_pylist(), batch.column(3)
            sizes = pc.binary_length(all_texts).to_pylist()
            ids, texts, nexts, size = [], [], [], 0
            for i, part in enumerate(parts):
                row = (part, all_ids[i], all_texts[i].as_py())
                if held is not None and held[0] == part:
                    ids.append(held[1])
                    texts.append(held[2])
                    nexts.append(row[2])
                    size += sizes[i]
                held = None if lasts[i] else row
                if ids and (size > t.SLAB_BYTES or lasts[i] or i + 1 == len(parts)):
                    yield _compare(ids, texts, nexts, scale)
                    ids, texts, nexts, size = [], [], [], 0
    return with_next(docs).mapInArrow(run, OUT)
