"""Quality rules on documents and, from their failures, on the hosts they come from.

Every document is measured; failures of each rule are counted by host; a host's rate is shrunk
towards the other hosts' rates by a beta prior fitted to them; a host whose shrunk rate exceeds
the limit of a rule is condemned, and its verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm import textops as t
from tidings.session import stage

# Rules of the host verdict: a document fails, and the shrunk rate a host may have.
HOST_RULES = {
    "too_short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines",
}
HOST_LIMIT = 0.5
BASE_FAILED = f"({HOST_RULES['too_short']}) OR ({HOST_RULES['repetitive']})"
SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(hashes: Column) -> Column:
    """Words inside three-word windows that occur twice or more, from the windows' hashes.

    Only a text with a repeated window is sorted. Equal neighbours of the sorted list give the
    places of repeated windows; each covers its own word and the next two.
    """
    places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.arrays_zip(places.alias("a"), F.slice(places, 2, F.size(hashes)).alias("b"))
    equal = F.filter(pairs, lambda p: p["a"]["h"] == p["b"]["h"])
    found = F.flatten(F.transform(equal, lambda p: F.array(
        p["a"]["i"], p["a"]["i"] + 1, p["a"]["i"] + 2, p["b"]["i"], p["b"]["i"] + 1, p["b"]["i"] + 2)))
    return F.size(F.array_distinct(found))


def measures(text: Column) -> dict[str, Column]:
    """What the rules are made from; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, t.SPACES, "") != "")
    return {"text": text, "words": words, "lines": lines}


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """``doc, doc_id, host`` and the measures of every row, ``doc`` holding the row as it came.

    ``n_dup_lines`` counts lines with a word that equal an earlier line, ``n_repeat_words`` words
    in three-word windows found at least twice, the first included.
    """
    parts = measures(F.col(text_col))
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(host_col).alias("host"), parts["text"].alias("text"),
        parts["words"].alias("words"), parts["lines"].alias("lines"))
    n_words = F.size("words")
    windows = F.arrays_zip("words", F.slice("words", 2, F.greatest(n_words, F.lit(1))).alias("second"),
                           F.slice("words", 3, F.greatest(n_words, F.lit(1))).alias("third"))
    hashes = F.transform(
        F.slice(windows, 1, F.greatest(n_words - 2, F.lit(0))), lambda w: F.xxhash64(w))
    rows = rows.select(
        "doc", "doc_id", "host", n_words.cast("bigint").alias("n_words"),
        F.char_length(F.translate("text", t.SPACES, "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        hashes.alias("hashes"))
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    n_repeat = F.when(repeated, _repeat_words(F.col("hashes"))).otherwise(0).cast("bigint")
    # Exploded from an array of one: a filter on a measure then reads its value, and is not pushed
    # below with the whole computation copied into it.
    one = F.struct("n_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines", n_repeat.alias("n_repeat_words"))
    rows = rows.select("doc", "doc_id", "host", F.explode(F.array(one)).alias("m"))
    return rows.select("doc", "doc_id", "host", "m.*").withColumn("base_failed", F.expr(BASE_FAILED))


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, host_rejected`` and the shrunk rates, from rows with ``host`` and the measures.

    For each rule the prior is a beta distribution with the mean and variance of the hosts' rates
    (each host counting once); ``(failures + a) / (documents + a + b)`` is a host's shrunk rate.
    Without variance, as with a single host, the prior has the weight of one document. Counting is
    a partial aggregation, so a host with most of the rows is no burden; the fit is one row.
    """
    counts = stage(rows.groupBy("host").agg(
        F.count("*").alias("n"),
        *[F.sum(F.expr(rule).cast("bigint")).alias(f"f_{k}") for k, rule in HOST_RULES.items()]), "hosts")
    moments = counts.agg(
        *[F.avg(F.col(f"f_{k}") / F.col("n")).alias(f"mean_{k}") for k in HOST_RULES],
        *[F.var_pop(F.col(f"f_{k}") / F.col("n")).alias(f"var_{k}") for k in HOST_RULES]).first()
    rates = []
    for k in HOST_RULES:
        mean, var = moments[f"mean_{k}"] or 0.0, moments[f"var_{k}"] or 0.0
        weight = max(mean * (1 - mean) / var - 1, 1.0) if var > 0 else 1.0
        rates.append(((F.col(f"f_{k}") + mean * weight) / (F.col("n") + weight)).alias(f"rate_{k}"))
    out = counts.select("host", *rates)
    worst = F.greatest(*[F.col(f"rate_{k}") for k in HOST_RULES])
    return out.withColumn("host_rejected", worst > limit)


def _with_verdicts(rows: DataFrame) -> DataFrame:
    hosts = host_verdicts(rows).select(F.col("host").alias("_host"), "host_rejected")
    joined = rows.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
    kept = ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("kept", kept).drop("_host", "host", "host_rejected", "n_lines")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           host_col: str = "source") -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every row.

    A row is kept unless it fails the base rules or its host is condemned. Null texts have no
    words; rows without host form a host of their own; repeated rows count each; an empty table
    gives no rows; other columns are not read.

    The measures, a few numbers a row, are stored once for counting and joining; the texts are
    never shuffled. Hosts are joined by Spark's own choice: a broadcast where their table is
    small, else a shuffle in which adaptive execution splits a host with many rows.
    """
    rows = measured(docs, id_col, text_col, host_col).drop("doc")
    return _with_verdicts(stage(rows, "measures"))


def passing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source") -> DataFrame:
    """The rows that ``judged`` keeps, as they came, whatever their other columns are called.

    Null and empty texts have no words and fail. Rows without host are a host of their own.
    Repeated rows and null ids are judged like any; an empty table stays empty.
    The measures are computed twice, for the counts and for the rows, instead of storing or
    shuffling the texts by id.
    """
    rows = measured(docs, id_col, text_col, host_col)
    return _with_verdicts(rows).where("kept").select("doc.*")
