"""Near-duplicate documents: fast similarity sketches, bands, exact verification, components.

Sketch: in round ``i`` every shingle is hashed to one bin and to a value that lies above all values
of earlier rounds; a bin keeps its least value. After as many rounds as bins each further round
fills one given bin, so every coordinate is filled, and a bin's value is that of a random shingle.

Texts with equal shingle sets are one class from the start. Classes that share a band of
coordinates are candidates; chains of candidates form clusters; inside a cluster, in tiles of
bounded size, all links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.llm.components import components
from tidings.session import stage

# Two sets at the least similarity share no band with probability (1 - s**ROWS)**BANDS: at 0.85
# that is 7e-7, at 0.8 5e-5.
ROWS = 6
BANDS = 30
LEAST = 85  # per cent
# Classes of a cluster that share a tile; two tiles meet in one task.
TILE = 192

SIGNATURES = "doc_id bigint, text_hash bigint, n_shingles bigint, key binary, bands array<bigint>"


def similarity_sketches(values: np.ndarray, owner: np.ndarray, sets: int, bins: int) -> np.ndarray:
    """``sets x bins`` coordinates of the sets whose elements are ``values``; an empty set has none."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(sets * bins, top, np.uint64)
    base = owner * bins
    for i in range(2 * bins):
        if not len(values):
            break
        hashes = t.mix(values ^ t.mix(np.full(1, i + 1, np.uint64)))
        if i < bins:
            bin_of = ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            bin_of = i - bins
        np.minimum.at(out, base + bin_of, np.uint64(i << 32) | hashes >> np.uint64(32))
        open_sets = (out.reshape(sets, bins) == top).any(axis=1)
        go_on = open_sets[owner]
        if not go_on.all():
            values, owner, base = values[go_on], owner[go_on], base[go_on]
    return out.reshape(sets, bins)


def band_hashes(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each run of ``rows`` coordinates; runs of different places never agree."""
    sets, bins = sketches.shape
    parts = t.mix(sketches.reshape(sets, bins // rows, rows) + np.arange(1, rows + 1, dtype=np.uint64))
    places = (np.arange(rows, dtype=np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
    total = (parts * places).sum(axis=2, dtype=np.uint64)
    return t.mix(total + np.arange(1, bins // rows + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Size, digest and bands of every text's shingle set; key and bands are null for empty sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for first, data, offsets in t.slabs(texts):
                starts, ends, word = t.word_bounds(data, offsets)
                hashes, at = t.shingle_hashes(t.word_hashes(data, starts, ends), word)
                sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:])]
                sizes = np.array([len(s) for s in sets])
                owner = np.repeat(np.arange(len(sets)), sizes)
                values = np.concatenate(sets)
                found = band_hashes(similarity_sketches(values, owner, len(sets), bands * rows), rows)
                keys = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                listed = [b.view(np.int64) if len(s) else None for b, s in zip(found, sets)]
                here = slice(first, first + len(sets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[here], batch.column(1)[here], pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(listed, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "n_shingles", "key", "bands"])

    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, SIGNATURES)


def clusters(classes: DataFrame) -> DataFrame:
    """``node, cluster`` of the classes (``node, bands``) that share a band with another.

    A bucket of any size gives one edge a member, to its least member, so its size does not matter.
    """
    banded = classes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    edges = banded.join(hubs.where("hub <> last").select("band", "hub"), "band")
    found = components(edges.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    return found.withColumnRenamed("component", "cluster")


def linked(sets: list[np.ndarray], left: np.ndarray | None, least: int) -> list[tuple[int, int]]:
    """A forest with the same components as all links among ``sets``.

    Sizes of all intersections come from products of 0/1 matrices, a block of shingles at a time;
    shingles of a single set are left out. With ``left`` given, only links between sets where it
    is true and sets where it is false count.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    same = values[1:] == values[:-1]
    shared = np.zeros(len(values), bool)
    shared[1:] |= same
    shared[:-1] |= same
    new = np.ones(len(values), bool)
    new[1:] = ~same
    owner, number = owner[shared], np.cumsum(new[shared]) - 1
    both = np.zeros((n, n), np.float32)
    width = max(256, (4 << 20) // n)
    for at in range(0, number[-1] + 1 if len(number) else 0, width):
        a, b = np.searchsorted(number, [at, at + width])
        block = np.zeros((n, width), np.float32)
        block[owner[a:b], number[a:b] - at] = 1
        both += block @ block.T
    both = both.astype(np.int64)
    links = (100 * both >= least * (sizes[:, None] + sizes[None, :] - both)) & (both > 0)
    if left is not None:
        links &= left[:, None] != left[None, :]
    forest, seen = [], np.zeros(n, bool)
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        todo = [root]
        while todo:
            new_ones = np.flatnonzero(links[todo.pop()] & ~seen)
            seen[new_ones] = True
            todo += new_ones.tolist()
            forest += [(root, int(x)) for x in new_ones]
    return forest


def _verify(least: int):
    """Links inside the groups of rows ``cluster, i, j, tile, node, text set``, ordered by group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, tiles, sets = None, [], [], []

        def result() -> pa.RecordBatch:
            left = None if group[1] == group[2] else np.array(tiles) == group[1]
            forest = linked(sets, left, least) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([nodes[a] for a, _ in forest], pa.int64()),
                 pa.array([nodes[b] for _, b in forest], pa.int64())], ["a", "b"])

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
            rest = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5))
            for key, (tile, node, packed) in zip(keys, rest):
                if key != group:
                    if group is not None:
                        yield result()
                    group, nodes, tiles, sets = key, [], [], []
                nodes.append(node)
                tiles.append(tile)
                sets.append(np.frombuffer(packed.as_py(), np.uint64))
        if group is not None:
            yield result()
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed shingle set in place of the text, in the last column."""
    for batch in batches:
        packed = [np.unique(h).tobytes() for h in t.shingles(batch.column(4))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(packed, pa.binary())], ["cluster", "node", "k", "tile", "packed"])


def verified_links(docs: DataFrame, members: DataFrame, least: int) -> DataFrame:
    """``a, b``: links between classes of the same cluster, confirmed on their full shingle sets.

    A cluster is dealt into ``k`` tiles by a hash; every pair of tiles is one group, so a class is
    sent ``k`` times and no group grows with the cluster.
    """
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / TILE).cast("int").alias("k"))
    dealt = members.join(sizes, "cluster").select(
        "cluster", "node", "k", F.pmod(F.xxhash64("node"), "k").cast("int").alias("tile"))
    # Always a shuffle: what is a small table here grows with the documents.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text").join(dealt.hint("merge"), "node")
    packed = texts.select("cluster", "node", "k", "tile", "text").mapInArrow(
        _sets, "cluster bigint, node bigint, k int, tile int, packed binary")
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    groups = packed.select("*", other).select(
        "cluster", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        "tile", "node", "packed")
    return (
        groups.repartition(t.shuffle_partitions(docs), "cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(_verify(least), "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, least: int = LEAST, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents are linked when ``100 * intersection >= least * union`` of their shingle sets;
    ``component_id`` is the least id reachable and ``kept`` marks the document that has it. Texts
    without words are linked with nothing. Rows with the same id are one document. A row without
    id takes part, but names no component: if nothing with an id has the same set, its
    ``component_id`` is null and it is kept. An empty table gives no rows; other columns are not
    read. ``text_hash`` is ``xxhash64`` of the text, for joining rows without id.

    The sketches are stored once; the texts are shuffled once, to the classes that are candidates.
    Nothing but sums for the end of the component rounds comes to the driver.
    """
    docs = docs.select("doc_id", "text")
    found = stage(signatures(docs, bands, rows), "signatures")
    classes = found.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    classes = stage(classes.where("node IS NOT NULL"), "classes")
    members = stage(clusters(classes), "clusters")
    links = verified_links(docs, members, least)
    # Classes whose least id is the same (rows that repeat an id) are joined by that id itself.
    heads = components(links)
    named = classes.select("key", "node").join(heads, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component_id"))
    out = found.drop("bands").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.withColumn("component_id", component)
    kept = F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"))


def deduplicated(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows that are kept, as they came; of rows with the same id and text one.

    Rows with one id and different texts are one document and stay both. Of rows without id and
    with equal text one stays, unless a row with an id has the same shingles. Null and empty texts
    stay, one row for each id; an empty table stays empty.
    """
    marks = near_duplicates(docs, least).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_hash"),
        F.struct(*docs.columns).alias("doc"))
    same = [rows["_id"].eqNullSafe(marks["_id"]), rows["_hash"].eqNullSafe(marks["_hash"])]
    kept = rows.join(marks, same[0] & same[1], "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.select("doc.*")
