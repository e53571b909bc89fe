"""From raw documents to packed sequences, a stage at a time.

Each stage takes the session, the documents its predecessor kept and the folder
of the tables, and returns a DataFrame. Between two stages the documents are
written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import exact_dedup, packing, pii, quality, simhash
from sparkloom.llm.queries import WORD_TOKENIZER
from sparkloom.llm.shared import keep, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from the labels of the documents it is given.
    """
    return quality.drop_low_quality(docs, read(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return simhash.drop_near_copies(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in them replaced by its kind."""
    return pii.redact_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the sequences."""
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]

# Fits and packing have no SQL form; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
