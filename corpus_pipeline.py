"""From raw documents to tokens, in five stages.

Each stage works on all rows that the one before kept, and its decisions stand: unknown
languages, further copies and contaminated documents go, personal data are masked, and the
last stage tokenizes what is left. All stages but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, bpe, decontam, langid, pii
from tidemark.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents whose language cannot be told: null texts, texts without a
    letter, and those for which no language has half of the probability."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of every class of near copies."""
    return bagminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a passage of the benchmark."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of data in the place of every span found; n_chars follows."""
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(
            F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of their decoding."""
    return bpe.round_trip(docs, public_tokenizers.path(bpe.VOCABULARY))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Signatures, fitted models and byte-pair merges have no SQL form; tests/llm compares the
# pipeline with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
