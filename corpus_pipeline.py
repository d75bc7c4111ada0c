"""From raw documents to encoded training text: five stages, each over all its predecessor kept.

Every stage takes nulls in any column, empty and very long texts, repeated rows and empty tables; what
it makes of them stands with it. Columns beyond those of ``documents`` pass through all stages but the
last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidings.llm import mixing, neardup, pieces, quality, secrets
from tidings.llm.textops import read_table
from tidings.session import stage

# Near duplicates of the pipeline, in per cent of the union of five-word shingles.
LEAST_SIMILARITY = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does.

    Null and empty texts fail the rules; rows without source are one host; repeated rows are judged
    like any.
    """
    return quality.passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    Rows with the same id and text become one. Texts without words are like no other; a row without id
    stays if nothing with an id has the same shingles.
    """
    return neardup.deduplicated(docs, LEAST_SIMILARITY)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; null texts and repeated rows stay as they are."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, one row for each pass over a document.

    Documents without words are in no pass; rows without source are a source of their own.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and byte spans of the pieces of every text, and the text decoded from the ids.

    A null or empty text has no pieces and decodes to the empty text; rows stay as many as they are.
    """
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", remove_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

# The draws of the mixture and the pieces cannot be written in SQL; tests hold every stage
# against a plain computation instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"stage{number}")
    return docs
