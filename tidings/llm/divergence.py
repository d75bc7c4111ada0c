"""How far the sources of a language differ in their words, by exact whole-number divergences.

The terms of every (language, source) group are counted once. All pairs of groups are then compared
over all terms in a cube: a cell is a block of groups, a second block of groups and a block of
terms. The counts of a group in a term block form its slice, which is sent to every cell of its
group block; a cell works on dense arrays of bounded size, and its partial sums are added up along
the axis of terms. A group's size does not matter, since the terms of a large group are spread over
the term blocks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.session import stage

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# Mean groups and terms of a block: a cell holds arrays of about GROUPS * TERMS numbers.
GROUPS = 48
TERMS = 4096
# Distinct terms of all groups that a counting task holds before it hands them on.
HELD_TERMS = 250_000
CHUNK_BYTES = 1 << 20

# Letters a-z and all bytes from 128 stay, A-Z become a-z, the rest separates.
TABLE = bytes(c + 32 if 65 <= c < 91 else c if 97 <= c < 123 or c >= 128 else 32 for c in range(256))

_TERM_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_PARTIAL = (
    "lang string, source_a string, source_b string, value bigint, terms bigint, absent bigint, v bigint")


def _words(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK_BYTES:
            cut = data.find(b" ", at + CHUNK_BYTES)
            end = cut if cut >= 0 else end
        yield data[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of each group, and one row without term a group."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            mine = docs[lang, source]
            terms = pa.array([None, *found], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), len(terms)), pa.repeat(pa.scalar(source), len(terms)), terms,
                 pa.array([0, *found.values()], pa.int64()), pa.array([0, *map(mine.__getitem__, found)], pa.int64())],
                ["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for _, data, offsets in t.slabs(batch.column(2)):
            lowered = data.tobytes().translate(TABLE)
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                group = next(names)
                found, before = counts[group], len(counts[group])
                seen: set[bytes] = set()
                for words in _words(lowered[start:end]):
                    found.update(words)
                    seen.update(words)
                docs[group].update(seen)
                held += len(found) - before
                if held > HELD_TERMS:
                    yield from rows()
                    held = 0
    yield from rows()


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n, first`` of the terms a language keeps, and groups without a term.

    A term is kept where at least ``least_documents`` documents of the language have it. ``lang_n``
    counts it in the whole language, ``first`` is 1 in one row of each kept term. Every group has
    one more row, with a null term. Counted within tasks and then shuffled once, by language and
    term; all later steps of a term keep that place.
    """
    named = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = named.mapInArrow(_count, _TERM_COUNTS).repartition("lang", "term")
    sums = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    rows = sums.select(
        "lang", "source", "term", "n", F.sum("docs").over(term).alias("_docs"),
        F.sum("n").over(term).alias("lang_n"),
        (F.row_number().over(term.orderBy("source")) == 1).cast("bigint").alias("first"))
    kept = F.col("term").isNull() | (F.col("_docs") >= least_documents)
    return rows.where(kept).select(
        "lang", "source", "term", "n", "lang_n", F.when(F.col("term").isNull(), 0).otherwise(F.col("first")).alias("first"))


def group_totals(terms: DataFrame, groups: int = GROUPS, block_terms: int = TERMS) -> DataFrame:
    """``lang, source, total, lang_total, v`` and the blocks of the cube, one row a group."""
    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    langs = totals.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("firsts").alias("v"), F.count("*").alias("_groups"))

    def blocks(n: str, size: int) -> Column:
        return F.greatest(F.ceil(F.col(n) / size), F.lit(1)).cast("int")

    out = totals.drop("firsts").join(langs, "lang").select(
        "lang", "source", "total", "lang_total", "v", blocks("_groups", groups).alias("group_blocks"),
        blocks("v", block_terms).alias("term_blocks"))
    return out.withColumn("block", F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int"))


def _share(n: str, total: str) -> Column:
    """A smoothed share in parts of ``SCALE``, from exact decimals."""
    scaled = f"cast({n} + 2 AS decimal(20, 0)) * {SCALE}"
    return F.expr(f"1 + ({scaled}) div (cast({total} AS decimal(20, 0)) + 2 * cast(v AS decimal(18, 0)))")


def distinctive_terms(terms: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The ``top`` terms a group uses more than its language, by their part of the divergence."""
    rows = terms.where("term IS NOT NULL AND n > 0").join(groups, ["lang", "source"])
    shares = rows.select("lang", "source", "term", _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"))
    valued = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    # Each task keeps the first rows of a group before they are shuffled.
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _shares(counts: np.ndarray, totals: np.ndarray, v: int) -> np.ndarray:
    """``1 + SCALE * (n + 2) // (total + 2 v)`` by long division in three steps, exact below 2**53."""
    below = (totals + 2 * v)[:, None]
    rest, out = counts + 2, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of groups of one cell."""
    lang, a, b = (x.as_py() for x in key[:3])
    v = table.column("v")[0].as_py()
    listed = table.filter(pc.is_null(table.column("term")))
    order = np.argsort(np.array(listed.column("source").to_pylist(), object), kind="stable")
    names = [listed.column("source")[int(i)].as_py() for i in order]
    sides = np.array(listed.column("block"))[order]
    totals = np.array(listed.column("total"), np.int64)[order]
    place = {name: i for i, name in enumerate(names)}
    rows = table.filter(pc.is_valid(table.column("term")))
    coded = rows.column("term").combine_chunks().dictionary_encode()
    counts = np.zeros((len(names), len(coded.dictionary)), np.int64)
    counts[[place[x] for x in rows.column("source").to_pylist()], np.array(coded.indices)] = np.array(rows.column("n"))
    shares = _shares(counts, totals, v) if v else counts
    bare = _shares(np.zeros((len(names), 1), np.int64), totals, v)[:, 0] if v else totals * 0 + 1
    out = []
    for i in range(len(names)):
        if sides[i] != a:
            continue
        others = np.flatnonzero(sides == b)
        others = others[others > i] if a == b else others
        if not len(others):
            continue
        p, q = shares[i], shares[others]
        value = ((q - p) ** 2 // (q + p)).sum(axis=1) if v else np.zeros(len(others), np.int64)
        absent = (bare[others] - bare[i]) ** 2 // (bare[others] + bare[i])
        out.append((np.full(len(others), i), others, value, absent))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    text = pa.array(names, pa.string())
    n = len(columns[0])
    return pa.table({
        "lang": pa.repeat(pa.scalar(lang), n), "source_a": text.take(pa.array(columns[0])),
        "source_b": text.take(pa.array(columns[1])), "value": pa.array(columns[2]),
        "terms": pa.array(np.full(n, counts.shape[1])), "absent": pa.array(columns[3]),
        "v": pa.array(np.full(n, v)),
    })


def pair_divergences(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source_a, source_b, value``, each pair of groups once, from the cells of the cube.

    A slice goes to one cell for each group block of its language. Terms that no slice of a cell has
    are worth the same in all of them, so they are added from their number at the end.
    """
    slices = terms.where("term IS NOT NULL").join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "total", "v", "block", "group_blocks",
        F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t"))
    # Every cell hears of all its groups, also of those without a term in it.
    heads = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"), "total", "v",
        "block", "group_blocks", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("t"))
    sent = slices.unionByName(heads).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other"))
    cells = sent.select(
        "lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "t", "source", "term",
        "n", "total", "v", "block")
    partial = cells.groupBy("lang", "a", "b", "t").applyInArrow(_cell, _PARTIAL)
    sums = partial.groupBy("lang", "source_a", "source_b").agg(
        F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.max("absent").alias("absent"), F.max("v").alias("v"))
    return sums.select(
        "lang", "source_a", "source_b", (F.col("value") + (F.col("v") - F.col("terms")) * F.col("absent")).alias("value"))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: all pairs of sources, and the terms that tell them.

    Part ``pair`` has a row for every other source of the language, part ``term`` the ``top`` terms
    the group uses more than its language does; ranks run by value, then by item in UTF-8 order.
    Null text, language or source count as empty. Repeated rows count each time, ids are not read,
    nor other columns. A group without terms is compared all the same, a language of one group has
    no pairs, and one without kept terms has pairs of value 0; an empty table gives no rows. The
    terms that are kept are stored once. Runs jobs.
    """
    terms = stage(term_counts(docs, least_documents), "terms")
    groups = stage(group_totals(terms), "groups")
    pairs = pair_divergences(terms, groups)
    both = F.explode(F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))).alias("p")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = pairs.select("lang", both, "value").select(
        "lang", "p.source", "p.item", "value").withColumn("rank", F.row_number().over(order))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(ranked, "pair").unionByName(part(distinctive_terms(terms, groups, top), "term"))
