"""Mixing sources to target weights by drawing fixed-length blocks of words.

The words of a source, document after document, are cut into blocks of equal length. Each source
has a number of draws, and the slots of all output shards are dealt to the draws by a pseudorandom
permutation: the counts of a shard are multinomial under the condition that every source comes to
its number, so none is drawn too often or too rarely. The draws of a source run through
pseudorandom permutations of its block numbers, one permutation for each pass; blocks are joined by
number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.operators.ranking import rank_rows
from tidings.session import drop_staged, stage

BLOCK_WORDS = 128
SHARD_SLOTS = 4096
# Draws made by one row of the list of draws, and at a time.
CHUNK_DRAWS = 1 << 16
# Rows of a source, and sources, in one group of a running sum.
GROUP_ROWS = 8192
MAX_PASSES = 3
WEIGHTS = (1, 2, 3)
SEED = 20_240_229
_SLOTS = "shard bigint, slot int, src bigint, pass int, block bigint"


def with_targets(sources: DataFrame, passes: int = MAX_PASSES) -> DataFrame:
    """``target`` for ``size, weight``: the total shared by weight, at most ``passes`` sizes each.

    What a source cannot take is shared again by weight among the others, until none is above. Each
    round is one aggregation over the sources, of which one row comes to the driver. Should be
    called on a stored table.
    """
    size, weight = F.col("size").cast("double"), F.col("weight").cast("double")
    has = F.col("size") > 0
    cap = size * passes
    share, capped = None, F.lit(False)
    while True:
        # A source over its cap in one round is so in the next: what is left for a weight only grows.
        row = sources.agg(
            F.sum("size").cast("double").alias("total"), F.sum(F.when(has & capped, cap)).alias("full"),
            F.sum(F.when(has & ~capped, weight)).alias("weight"), F.count(F.when(has & capped, 1)).alias("n")).first()
        if row["weight"] is None:
            return sources.withColumn("target", F.when(has, cap).otherwise(F.lit(0.0)))
        rest = row["total"] - (row["full"] or 0.0)
        if share is not None and row["n"] == share[2]:
            even = weight * F.lit(rest) / F.lit(row["weight"])
            return sources.withColumn("target", F.when(~has, 0.0).when(capped, cap).otherwise(even))
        share = rest, row["weight"], row["n"]
        capped = (weight * F.lit(rest) / F.lit(row["weight"])) > cap


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``index`` under the permutation of ``0 .. n - 1`` that belongs to ``key``, element by element.

    Four Feistel rounds on the next even number of bits; results outside are sent through again.
    """
    bits = np.maximum((np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, m, b, k = out[todo], mask[todo], bits[todo], key[todo]
        left, right = x >> b, x & m
        for step in range(4):
            left, right = right, left ^ (t.mix(right + k * np.uint64(31) + np.uint64(step)) & m)
        out[todo] = left << b | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def draw_slots(plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``shard, slot, src, pass, block``: what every slot of the output takes.

    ``plan`` has ``src``, the number of ``blocks``, of ``draws``, at most ``passes`` times as many,
    and ``first``, the draws of the sources before. The draws are numbered through; a permutation of
    these numbers says which slot of which shard each takes. A source with most of the draws is
    made by many tasks, and no list of sources is held anywhere.
    """
    parts = t.shuffle_partitions(plan)
    total = plan.agg(F.coalesce(F.sum("draws"), F.lit(0))).scalar().alias("total")
    chunks = plan.where("draws > 0").select(
        "src", "blocks", "draws", "first", total, F.explode(F.expr(f"sequence(0, (draws - 1) div {CHUNK_DRAWS})")).alias("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, blocks, draws, first, total, chunk = (np.array(c, np.int64) for c in batch.columns)
            number = np.minimum(draws - chunk * CHUNK_DRAWS, CHUNK_DRAWS)
            # Many small sources at a time, or one chunk of a large one.
            part = np.cumsum(number) // CHUNK_DRAWS
            for rows in np.split(np.arange(len(src)), np.flatnonzero(np.diff(part)) + 1):
                if not len(rows):
                    continue
                n = number[rows]
                of = np.repeat(rows, n)
                draw = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + chunk[of] * CHUNK_DRAWS
                turn = draw // blocks[of]
                key = t.mix(np.uint64(seed) + t.mix(src[of].astype(np.uint64)) + turn.astype(np.uint64))
                block = permuted(draw % blocks[of], blocks[of], key)
                place = permuted(first[of] + draw, total[of], np.full(len(of), seed, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place // SHARD_SLOTS), pa.array((place % SHARD_SLOTS).astype(np.int32)), pa.array(src[of]),
                     pa.array(turn.astype(np.int32)), pa.array(block)], ["shard", "slot", "src", "pass", "block"])

    return chunks.repartition(parts, "src", "chunk").mapInArrow(run, _SLOTS)


def _before(n: str, *by: str) -> Column:
    """The sum of ``n`` over the rows before, by ``by``; the last of these is the order."""
    window = Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(window), F.lit(0))


def plan_sources(rows: DataFrame, block_words: int = BLOCK_WORDS, passes: int = MAX_PASSES, seed: int = SEED) -> DataFrame:
    """``source, src, source_size, target, blocks, draws, first, groups``, one row a source.

    ``rows`` has ``source, size``. Sources are numbered in the order of their code points, null
    last. A source has as many draws as blocks go into its target; of a fraction left over the draw
    is made with that chance. The table is stored; the driver sees sums only.
    """
    sums = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
    numbered = rank_rows(sums, F.asc_nulls_last("source"), name="_rank").withColumn("src", F.col("_rank") - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("src") % len(WEIGHTS) + 1).cast("int"))
    weighed = stage(numbered.select("source", "src", "rows", "size", weight.alias("weight")), "weighed")
    wanted = F.col("target") * F.col("blocks") / F.col("size")
    # From the seed and the number alone, in [0, 1).
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "src"), 11) / F.lit(float(1 << 53))
    draws = F.floor(wanted + 1e-9) + (chance < wanted - F.floor(wanted + 1e-9)).cast("bigint")
    counted = with_targets(weighed, passes).withColumn("blocks", F.expr(f"(size + {block_words - 1}) div {block_words}"))
    counted = counted.select(
        "source", "src", F.col("size").alias("source_size"), "target", "blocks",
        F.when(F.col("size") > 0, F.least(draws, F.col("blocks") * passes)).otherwise(0).cast("bigint").alias("draws"),
        F.ceil(F.col("rows") / GROUP_ROWS).alias("groups"), F.expr(f"src div {GROUP_ROWS}").alias("_part"))
    # The sums of the parts run in one task, of which there is one for thousands of sources.
    parts = counted.groupBy("_part").agg(F.sum("draws").alias("_n")).select("_part", _before("_n", "_part").alias("_base"))
    inner = counted.withColumn("_inner", _before("draws", "_part", "src"))
    plan = inner.join(parts, "_part").withColumn("first", F.col("_base") + F.col("_inner"))
    out = stage(plan.drop("_part", "_base", "_inner"), "plan")
    drop_staged(weighed)
    return out


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``src``, ``start`` (words of the source before the row) and the target.

    The running sum is over groups of rows of a source and then inside each group, so a source
    with most of the rows is spread over many tasks.
    """
    sources = plan.select(F.col("source").alias("_source"), "src", "source_size", "target", "groups")
    rows = rows.join(sources, rows["source"].eqNullSafe(F.col("_source"))).drop("_source", "source")
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "hash"), "groups"))
    sums = rows.groupBy("src", "group").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("src").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("src", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "group").orderBy("doc_id", "hash", "row").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(bases, ["src", "group"]).withColumn("start", F.col("base") + F.col("inner")).drop(
        "base", "inner", "group", "groups")


def _draws(placed: DataFrame, slots: DataFrame, block_words: int) -> DataFrame:
    """``row, pass, first, last``: words (last exclusive) of each row that a drawn block takes."""
    taken = placed.where("size > 0").select(
        "row", "src", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block_words),
                             F.floor((F.col("start") + F.col("size") - 1) / block_words))).alias("block"))
    begin = F.col("block") * block_words - F.col("start")
    # The slots grow with the data, which their estimated size does not show: never a broadcast.
    hit = taken.join(slots.select("src", "block", "pass").hint("merge"), ["src", "block"])
    return hit.select(
        "row", "pass", F.greatest(begin, F.lit(0)).alias("first"),
        F.least(begin + block_words, F.col("size")).alias("last"))


def _sized(docs: DataFrame) -> DataFrame:
    """``row, doc_id, source, size, hash`` of every row; ``row`` tells rows apart once stored."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(t.WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("hash"))


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, passes: int = MAX_PASSES, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row.

    Size is the number of words, 0 for a null text; rows without source are a source of their own,
    the last. Equal data give equal draws in every run. An empty table gives no rows; other
    columns are not read. Texts are read once and not shuffled.
    """
    rows = stage(_sized(docs), "sized")
    plan = plan_sources(rows, block_words, passes, seed)
    placed = _placed(rows, plan)
    slots = draw_slots(plan, seed)
    taken = _draws(placed, slots, block_words).groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, passes: int = MAX_PASSES,
                    seed: int = SEED) -> DataFrame:
    """The documents of the mixture, with the columns of ``docs``: one row for each document and pass.

    The text is what the pass takes of the document: all of it, or the parts that drawn blocks
    cover, each from its first word to its last, joined by line feeds. ``n_chars``, if there is
    such a column, is counted anew. Documents without words, null texts among them, are in no block
    and not in the mixture; an empty table gives an empty mixture. Rows without source are a source
    of their own. Repeated rows are rows of their own.
    """
    columns = docs.columns
    whole = stage(docs.select(F.struct(*columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    sized = whole.select(
        "row", F.col("doc.doc_id").cast("bigint").alias("doc_id"), F.col("doc.source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("doc.text", F.lit(t.WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("doc.text").alias("hash"))
    sized = stage(sized, "sized")
    plan = plan_sources(sized, block_words, passes, seed)
    placed = _placed(sized, plan)
    slots = draw_slots(plan, seed)
    runs = _draws(placed, slots, block_words).groupBy("row", "pass").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    found = whole.join(runs, "row").select("doc", "runs")
    at = {n: i for i, n in enumerate(columns)}
    words = re.compile(t.WORD)

    def cut(text: str, parts: list[dict]) -> str:
        spans = [m.span() for m in words.finditer(text)]
        merged: list[list[int]] = []
        for part in parts:
            if merged and merged[-1][1] == part["first"]:
                merged[-1][1] = part["last"]
            else:
                merged.append([part["first"], part["last"]])
        if merged == [[0, len(spans)]]:
            return text
        return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in merged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = batch.column(0).flatten()
            texts = [cut(x, p) for x, p in zip(fields[at["text"]].to_pylist(), batch.column(1).to_pylist())]
            fields[at["text"]] = pa.array(texts, fields[at["text"]].type)
            if "n_chars" in at:
                kind = fields[at["n_chars"]].type
                fields[at["n_chars"]] = pa.array([len(x) for x in texts], pa.int64()).cast(kind)
            yield pa.RecordBatch.from_arrays(fields, columns)
    return found.mapInArrow(run, docs.schema)
