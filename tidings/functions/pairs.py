"""Pairs of names as a table function for SQL."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

# The function below travels to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that are handed on at a time.
BLOCK_ROWS = 100_000
# Pairs that wait to be added up; some 40 bytes each.
WAITING_ROWS = 1_000_000


def pair_blocks(names: list[str], times: list[int]) -> Iterator[pa.Table]:
    """All ordered pairs of distinct names with the product of their multiplicities, in blocks."""
    column, n = pa.array(names, pa.string()), np.array(times, np.int64)
    every = np.arange(len(names))
    step = max(1, BLOCK_ROWS // len(names))
    for first in range(0, len(names), step):
        some = every[first : first + step]
        yield pa.table({
            "name_a": column.take(pa.array(np.repeat(some, len(every)))),
            "name_b": column.take(pa.array(np.tile(every, len(some)))),
            "n": pa.array(np.outer(n[some], n).ravel()),
        })


class HalfPairs:
    """Pairs with ``name_a <= name_b`` of many lists, equal ones added up as long as they wait."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.keys, self.counts, self.size = [], [], 0

    def add(self, runs: Counter, copies: int) -> Iterator[pa.Table]:
        names = sorted(runs)
        n = np.array([runs[x] for x in names], np.int64)
        every, step = np.arange(len(names)), max(1, BLOCK_ROWS // len(names))
        for first in range(0, len(names), step):
            # Blocks handed on forget the numbers of the names.
            number = np.array([self.numbers.setdefault(x, len(self.numbers)) for x in names], np.int64)
            some = every[first : first + step]
            partners = len(names) - some
            left = np.repeat(some, partners)
            # Counts on from each name to the last one.
            right = np.arange(len(left)) + np.repeat(some - (np.cumsum(partners) - partners), partners)
            self.keys.append(number[left] << 32 | number[right])
            self.counts.append(n[left] * n[right] * copies)
            self.size += len(left)
            if self.size >= WAITING_ROWS:
                yield self.taken()

    def taken(self) -> pa.Table:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts, keys = np.add.reduceat(counts[order], heads), keys[heads]
        column = pa.array(list(self.numbers), pa.string())
        self.__init__()
        return pa.table({
            "name_a": column.take(pa.array(keys >> 32)), "name_b": column.take(pa.array(keys & 0xFFFFFFFF)),
            "n": pa.array(counts)})


@arrow_udtf(returnType="name_a string, name_b string, n bigint")
class NamePairs:
    """``name_pairs(TABLE(SELECT list FROM ...))``: a row for each ordered pair of distinct names of a list.

    ``name_pairs(TABLE(SELECT list, copies FROM ...), true)`` gives pairs with ``name_a <= name_b``
    only, and one row for those of several lists where they come close together; ``copies`` says how
    often a list is there.
    """

    def eval(self, rows: pa.RecordBatch, once=None) -> Iterator[pa.Table]:
        half = HalfPairs() if once is not None and once[0].as_py() else None
        texts = rows.column(0).to_pylist()
        copies = rows.column(1).to_pylist() if half else texts
        for text, times in zip(texts, copies):
            if text is not None:
                # ";" separates items, "," a name from its trailing fields.
                runs = Counter(item.split(",", 1)[0] for item in text.split(";"))
                if half:
                    yield from half.add(runs, times)
                else:
                    yield from pair_blocks(list(runs), list(runs.values()))
        if half and half.size:
            yield half.taken()


def register_pairs(spark: SparkSession, name: str = "name_pairs") -> None:
    """The table function of a one-column table of names strings: ``name_a, name_b, n``.

    A pair of a list is one row that says how often the list has it, so a list is a stream of rows
    in blocks of bounded size and never one value; lists are read by as many tasks as the table has
    partitions. NULL lists have no rows.
    """
    spark.udtf.register(name, NamePairs)
