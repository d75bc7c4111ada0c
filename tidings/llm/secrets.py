"""Spans of secrets in texts: fixed patterns, and values of credentials that are hard to guess.

A value in a credential context is cut into words, dates, repeats, keyboard walks, sequences and
brute-force spans so that the number of guesses is least; what stays hard is reported. The words are
those of passwords and, behind them, the most frequent ones of the texts themselves, so that prose
after a keyword is easy to guess in the language it is written in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.operators.ranking import rank_rows

KINDS = ("assign", "access", "hex", "guess")
# Powers of ten of the guesses from which a value counts as a secret.
MIN_GUESSES = 10.0
# The longest word of the dictionary; repeats, walks, sequences and brute force have no limit.
LONGEST = 32
# Shorter values are no secrets, however they are made.
SHORTEST_VALUE = 6
# Words of the texts in the dictionary, the most frequent ones: a list that every task holds, at
# most some 4 MB. A word beyond it costs what brute force does.
CORPUS_WORDS = 100_000
# A word of the texts is one that stands in this many documents at least.
WORD_DOCUMENTS = 2
# Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 300_000
# Each segment after the first multiplies the guesses by this power of ten.
SEGMENT = 0.5

# Keywords and classes of the base patterns.
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
# Wider contexts for the guess cost: a name that holds a keyword, and a value of any visible
# characters. A name is read once from its start, so long names take linear time.
_NAME = re.compile(r"""(?<![\w.-])([\w.-]++)["']?\x20*[:=]\x20*""")
_KEY = re.compile(r"(?ai:pass|pwd|secret|token|api[_-]?key|credential|auth)")
_VALUE = re.compile(r""""([^"\n]+)"|'([^'\n]+)'|([^\s"'<>,;]+)""")
# Ordinary words that hold a keyword.
_ORDINARY = re.compile(
    r"(?ai:author(?!iz)[a-z]*|authentic(?:ity)?(?![a-z])|passages?(?![a-z])|passengers?|passports?"
    r"|passi(?:on|ve)[a-z]*|compass[a-z]*|bypass[a-z]*|secretar[a-z]*)")
# A cheap test that every context passes.
_HINT = re.compile(r"(?ai:pass|pwd|secret|token|api[_-]?key|credential|auth)")

# Common words of passwords in the order of how often they are tried.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome letmein secret login master hello monkey dragon "
    "sunshine princess football shadow iloveyou superman baseball access batman trustno "
    "test user root guest changeme default example token please summer winter spring autumn "
    "company service server database secure private public love money freedom whatever "
    "computer internet january february march april may june july august september october "
    "november december monday friday sunday pass key demo temp sample your here none null "
    "true false placeholder replace dummy value string xxxx").split()
# Rows of a keyboard, and the letters that digits and signs stand for.
KEYBOARD_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4@831!0$57", "aabeiiosst")

_DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")


@lru_cache(maxsize=1)
def _neighbours() -> dict[str, set[str]]:
    """Keys that touch each other on the keyboard; lower rows are shifted by half a key."""
    at = {key: (row, i + row / 2) for row, keys in enumerate(KEYBOARD_ROWS) for i, key in enumerate(keys)}
    return {
        a: {b for b, (s, y) in at.items() if b != a and abs(r - s) <= 1 and abs(x - y) <= (1 if r == s else 0.5)}
        for a, (r, x) in at.items()
    }


def _alphabet(char: str) -> float:
    """Power of ten of the characters that a brute-force guess runs through."""
    if char.isascii():
        if char.isdigit():
            return 1.0
        return log10(26) if char.isalpha() else log10(33)
    return 2.0


def _word_cost(piece: str, ranks: dict[str, int]) -> float | None:
    """Guesses of a dictionary word: its rank, times two for capitals, times two for stand-ins."""
    low = piece.lower()
    cost = 0.0 if piece == low else log10(2)
    if low not in ranks:
        low = low.translate(LEET)
        cost += log10(2)
    return None if low not in ranks else cost + log10(ranks[low] + 1)


def _run_option(starts: list[tuple[float, int]], cost: float, end: int, kind: str) -> list[tuple[float, str, int]]:
    """The cheapest run of three or more characters that ends here, after a new start is noted.

    A run costs what its start does and the logarithm of its length. A later start that costs no
    more is always better; one that costs more by what it can save at most is never.
    """
    new = end - 1
    if all(cost - c < log10((new + 3 - s) / 3) for c, s in starts):
        while starts and starts[-1][0] >= cost:
            starts.pop()
        starts.append((cost, new))
    found = [(c + log10(end - s), kind, s) for c, s in starts if end - s >= 3]
    return [min(found)] if found else []


def guess_cost(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """Least power of ten of the guesses for ``value``, and the segments that reach it.

    ``best[i]`` is the least cost of the first ``i`` characters. Brute force and walks cost the same
    for each further character, so the cheapest span that ends here is kept, of walks one for each
    length up to the least. The cost of repeats and sequences grows with the logarithm of their
    length: of their starts those are kept that some end may prefer, few in practice.
    """
    n = len(value)
    low, near = value.lower(), _neighbours()
    best: list[tuple[float, str, int]] = [(0.0, "", 0)]
    brute = None  # (cost so far, start) of the span that ends here
    walks: list = [None] * 4  # of walks of 1, 2, 3 and more characters
    repeats: list[tuple[float, int]] = []
    steps: dict[int, list[tuple[float, int]]] = {1: [], -1: []}
    for end in range(1, n + 1):
        char = value[end - 1]
        open_cost = best[end - 1][0] + (SEGMENT if end > 1 else 0.0)
        size = _alphabet(char)
        # Brute force: one more character, or a new span.
        fresh = (open_cost + size, end - 1)
        brute = min((brute[0] + size, brute[1]), fresh) if brute else fresh
        options = [(brute[0], "brute", brute[1])]
        # Repeats of one character: the character and how often.
        if end > 1 and value[end - 2] != char:
            repeats = []
        options += _run_option(repeats, open_cost + size, end, "repeat")
        # Keyboard walks: a start key, then about four directions a step.
        if end > 1 and low[end - 1] in near.get(low[end - 2], ()):
            further = [w and (w[0] + log10(4) / 2, w[1]) for w in walks]
            longer = [w for w in further[2:] if w]
            walks = [None, *further[:2], min(longer) if longer else None]
        else:
            walks = [None] * 4
        walks[0] = (open_cost + log10(47), end - 1)
        if walks[3]:
            options.append((walks[3][0], "walk", walks[3][1]))
        # Sequences of neighbouring characters, as in abcd or 4321.
        for way, starts in steps.items():
            if end > 1 and ord(char) - ord(value[end - 2]) != way:
                starts.clear()
            options += _run_option(starts, open_cost + log10(20), end, "sequence")
        for start in range(max(0, end - LONGEST), end - 2):
            piece = value[start:end]
            begin = best[start][0] + (SEGMENT if start else 0.0)
            cost = _word_cost(piece, ranks)
            if cost is not None:
                options.append((begin + cost, "word", start))
            if end - start <= 10 and (piece[0].isdigit() and piece[-1].isdigit()) and _DATE.fullmatch(piece):
                options.append((begin + log10(365 * 100 if end - start > 4 else 100), "date", start))
        best.append(min(options))
    segments, end = [], n
    while end:
        _, kind, start = best[end]
        segments.append((kind, start, end))
        end = start
    return best[n][0], segments[::-1]


def word_ranks(words=COMMON_WORDS) -> dict[str, int]:
    return {w: i for i, w in reversed(list(enumerate(words, 1))) if 3 <= len(w) <= LONGEST}


# Letters a-z and all bytes from 128 stay, A-Z become a-z, the rest separates.
_LETTERS = bytes(c if 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def _word_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the task have each word."""
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        words = [w for w in counts if len(w) <= 4 * LONGEST]
        columns = [pa.array([w.decode().lower() for w in words]), pa.array([counts[w] for w in words], pa.int64())]
        columns[0] = columns[0].cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        for _, data, offsets in t.slabs(batch.column(0)):
            lowered = data.tobytes().translate(_LETTERS)
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                counts.update(set(lowered[start:end].split()))
                if len(counts) > HELD_WORDS:
                    yield rows()
                    counts.clear()
    yield rows()


def corpus_words(docs: DataFrame, text_col: str = "text", most: int = CORPUS_WORDS,
                 least_documents: int = WORD_DOCUMENTS) -> list[str]:
    """The words of letters that most documents have, by their number, then by word; at most ``most``.

    Counted over all whole texts, within the tasks and then once by word, lower-cased; a document
    counts once for each way it capitalises letters beyond A-Z. The words are ranked where they lie,
    and only the ``most`` that are returned come to the driver. Null texts have none, repeated rows count each time. Runs a job.
    """
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_word_documents, "word string, n bigint")
    sums = counted.groupBy("word").agg(F.sum("n").alias("n"))
    wanted = sums.where((F.col("n") >= least_documents) & F.char_length("word").between(3, LONGEST))
    ranked = rank_rows(wanted, F.desc("n"), F.asc("word"), name="rank").where(F.col("rank") <= most)
    return [r.word for r in sorted(ranked.select("rank", "word").collect())]


def dictionary(docs: DataFrame, text_col: str = "text", words=COMMON_WORDS) -> dict[str, int]:
    """Ranks of the given words, then of the words of the texts."""
    return word_ranks([*words, *corpus_words(docs, text_col)])


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    if _HINT.search(text):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def guess_spans(text: str, ranks: dict[str, int], least: float = MIN_GUESSES) -> list[tuple[int, int, str]]:
    """Values in credential contexts that cost at least ``10 ** least`` guesses."""
    found, at = [], 0
    if _HINT.search(text):
        while name := _NAME.search(text, at):
            at = name.end()
            if not _KEY.search(_ORDINARY.sub("", name[1])):
                continue
            m = _VALUE.match(text, at)
            if m:
                at = m.end()
                value = m[m.lastindex]
                if len(value) >= SHORTEST_VALUE and guess_cost(value, ranks)[0] >= least:
                    found.append((*m.span(m.lastindex), "guess"))
    return found


def all_spans(base: list, guessed: list) -> list[tuple[int, int, str]]:
    return sorted(base + guessed, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every span replaced by ``mark``; overlapping spans become one."""
    out, done = [], 0
    merged: list[list[int]] = []
    for start, end, _ in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[done:start], mark]
        done = end
    return "".join([*out, text[done:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         least: float = MIN_GUESSES, words=COMMON_WORDS) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans`` of every whole text.

    Positions count code points, ends are exclusive; ``spans`` are ordered by start, then kind.
    ``base_sha256`` is over the spans of the fixed patterns only. A null or empty text has none.
    Values of credential contexts with fewer than ``SHORTEST_VALUE`` characters are not looked at,
    and words of more than ``LONGEST`` are no part of the dictionary, which is made of ``words``
    and the ``CORPUS_WORDS`` most frequent words of the texts (a job of its own). Repeated rows and
    null ids stay as they are, texts are not shuffled, an empty table gives no rows; other columns
    are not read.
    """
    ranks = dictionary(docs, text_col, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                spans = all_spans(base, guess_spans(text, ranks, least))
                counts = [sum(s[2] == k for s in spans) for k in KINDS]
                rows.append((*counts, sha256(joined(base).encode()).hexdigest(), joined(spans)))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, (
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, "
        "base_sha256 string, spans string"))


def redact(docs: DataFrame, text_col: str = "text", least: float = MIN_GUESSES,
           words=COMMON_WORDS, mark: str = "[SECRET]") -> DataFrame:
    """The rows as they came, what ``find`` reports in ``text_col`` replaced by ``mark``.

    A null text stays null, an empty table stays empty, repeated rows stay repeated.
    """
    ranks, at = dictionary(docs, text_col, words), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(at):
                text = text.as_py()
                spans = text and all_spans(base_spans(text), guess_spans(text, ranks, least))
                texts.append(redacted(text, spans, mark) if spans else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
    return docs.mapInArrow(run, docs.schema)
