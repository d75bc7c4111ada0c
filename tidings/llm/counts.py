"""Token counts of whole texts, without keeping a token.

Arrow batches are cut anew by bytes, so a task holds about the same amount of text at any time
however long its rows are. A longer text is taken in parts, cut only where the tokenizer ends a
token whatever stands on either side. The same places cut a part into words, of which each distinct
one goes to the library once a batch.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text bytes of a batch, and about the length of the parts of a longer text.
BATCH_BYTES = 1 << 20
# Words remembered by a worker in each of two generations, and the longest one remembered. They
# bound its memory (some 100 MB) and change no count.
KEPT_WORDS = 250_000
KEPT_CHARS = 40
LIMIT = 512
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

# White space by any library's definition.
_BLANK = r"\s\x1c-\x1f\x85᠎​﻿"
_MARK = "▁"
# Fixed value: a pre-tokenizer's pattern that leaves white space out of every token.
_NO_BLANKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Boundaries:
    """Where a text may be cut: at spaces with the given characters on neither side.

    ``lead`` is what a word behind a cut is encoded with. In ``simple`` texts every space is such
    a place. With ``feed`` so is a line feed there, which is a token by itself.
    """

    def __init__(self, outside: str, lead: str, awkward: str, contents: tuple[str, ...] = (), feed: bool = False):
        self.lead, self.feed = lead, feed
        self._awkward = re.compile(awkward)
        self._contents = contents
        self.places = re.compile(f"(?<=[^{outside}]) (?=[^{outside}])")

    def simple(self, text: str) -> bool:
        return not any(x in text for x in self._contents) and not self._awkward.search(text)

    def parts(self, text: str, size: int) -> Iterator[str]:
        """The text in parts of about ``size`` characters; what no place cuts stays whole."""
        at = 0
        while len(text) - at > size:
            found = self.places.search(text, at + size)
            if not found:
                break
            yield text[at : found.start()]
            # The space leads the next part, or is added again where the tokenizer adds it.
            at = found.start() if self.lead else found.end()
        yield text[at:]


class Counter:
    """Token counts of texts under one tokenizer file."""

    def __init__(self, encode: Callable[[list[str]], list[int]], boundaries: Boundaries | None):
        self._encode = encode
        self.boundaries = boundaries
        # Counts of words at the start of a text or line, and of words behind a space.
        self._known: dict[str, dict[str, int]] = {"": {}, " ": {}}
        self._old: dict[str, dict[str, int]] = {"": {}, " ": {}}
        self._long: list[tuple[dict[str, int], list[str]]] = []

    def _batches(self, texts: list[str]) -> list[int]:
        out, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= BATCH_BYTES // 4:
                out += self._encode(some)
                some, size = [], 0
        return out + (self._encode(some) if some else [])

    def _learn(self, lead: str, words: set[str]) -> dict[str, int]:
        """Counts that hold every one of the words, until the next batch."""
        if len(self._known[lead]) > KEPT_WORDS:
            self._old[lead], self._known[lead] = self._known[lead], {}
        known, old = self._known[lead], self._old[lead]
        new = words.difference(known)
        back = new.intersection(old)
        known.update((x, old[x]) for x in back)
        new = list(new - back)
        known.update(zip(new, self._batches([lead + x for x in new])))
        self._long.append((known, [x for x in new if len(x) > KEPT_CHARS]))
        return known

    def __call__(self, texts: list[str]) -> list[int]:
        cut = self.boundaries
        if cut is None:
            return self._batches(texts)
        out = []
        some: list[str] = []
        for text in texts:
            if len(text) <= BATCH_BYTES:
                some.append(text)
                continue
            out += self._words(some)
            out.append(sum(self._words([part])[0] for part in cut.parts(text, BATCH_BYTES)))
            some = []
        return out + self._words(some)

    def _words(self, texts: list[str]) -> list[int]:
        cut = self.boundaries
        lines = []
        for text in texts:
            if cut.simple(text):
                some = text.split("\n") if cut.feed else [text]
                lines.append([x.split(" ") for x in some])
            else:
                lines.append([cut.places.split(text)])
        first = {line[0] for some in lines for line in some}
        later = set().union(*(line[1:] for some in lines for line in some))
        if cut.lead:
            heads, rest = self._learn("", first), self._learn(cut.lead, later)
        else:
            heads = rest = self._learn("", first | later)
        of = rest.__getitem__
        counts = [
            len(some) - 1 + sum(heads[line[0]] + sum(map(of, line[1:])) for line in some)
            for some in lines]
        for known, words in self._long:
            for word in words:
                del known[word]
        self._long.clear()
        return counts


def _json_counter(path: str) -> Counter:
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[int]:
        return [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return Counter(encode, _json_boundaries(json.loads(tokenizer.to_str())))


def _json_boundaries(config: dict) -> Boundaries | None:
    """For the two kinds whose patterns are known; texts of others are encoded whole."""
    added = config["added_tokens"]
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(f"[{_BLANK}]", x["content"]) for x in added):
        return None
    contents = tuple(x["content"] for x in added)
    before, normal = config["pre_tokenizer"] or {}, config["normalizer"]
    awkward = f"[{_BLANK}][{_BLANK}]"
    if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
        return Boundaries(_BLANK, " ", awkward, contents, feed=True)
    first = (before.get("pretokenizers") or [{}])[0]
    steps = [x["type"] for x in (normal or {}).get("normalizers", [])]
    if (first.get("type"), first.get("pattern"), first.get("behavior"), first.get("invert")) == (
            "Split", {"Regex": _NO_BLANKS}, "Removed", True) and steps == ["NFC", "Replace", "Lowercase"]:
        return Boundaries(_BLANK, "", awkward, contents)
    return None


def _model_counter(path: str) -> Counter:
    import sentencepiece

    from tidings.llm.pieces import Rules

    with open(path, "rb") as file:
        model = file.read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)

    def encode(texts: list[str]) -> list[int]:
        return [len(x) for x in library.encode(texts, num_threads=1)] if texts else []

    rules = Rules.of(model)
    names = (library.id_to_piece(i) for i in range(library.vocab_size()))
    # The library puts a space before a text, so a word behind a cut is encoded as one at the
    # start; no piece may go on behind a space mark.
    apart = (
        not len(rules.units) and rules.dummy_prefix and rules.escape and not rules.squeeze
        and not any(_MARK in x.lstrip(_MARK) for x in names))
    return Counter(encode, Boundaries(f" {_MARK}", "", rf"  |{_MARK}|\A | \Z") if apart else None)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter a worker process and tokenizer file (``.json`` or ``.model``)."""
    return _model_counter(path) if path.endswith(".model") else _json_counter(path)


def balanced(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows that together hold about ``BATCH_BYTES``, one row at least."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + BATCH_BYTES, "right")), start + 1)
        yield start, stop
        start = stop


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text; no shuffle, rows are independent.

    Counts are those of the library of the file, without added begin, end or special tokens,
    truncation or padding; strings of special tokens inside a text count as the library has it by
    default. A null text is empty, an empty one has no tokens. Repeated rows and null ids stay as
    they are, an empty table gives none, other columns are not read. ``over_limit`` says that there
    are more than ``limit`` tokens. A text without any safe boundary, and every text of a tokenizer
    whose pattern is not known, is encoded whole. ``tokenizer_file`` has to be readable under the
    same path on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_file)
        for batch in batches:
            sizes = np.array(batch.column(2), np.int64)
            for start, stop in balanced(sizes):
                tokens = np.array(count(batch.column(1).slice(start, stop - start).to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(sizes[start:stop]), pa.array(tokens),
                     pa.array(tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"),
        F.octet_length(text).cast("bigint").alias("size"))
    return rows.mapInArrow(run, COUNTS)
