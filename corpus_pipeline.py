"""Corpus pipeline over the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``.

Nulls and ties, in every stage: a null or empty text is an empty document (it
is scored, is its own near-duplicate group, has no personal data, and leaves
at the mix, which takes no words of it); null ids and sources are values like
any other; repeated rows are one document from the second stage on; an empty
table stays empty with its columns; further columns are carried to the mix,
whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmarts.llm import bpe, mixing, pii, quality, simhash
from marketmarts.llm.common import load, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below the bound go."""
    return quality.keep_good(docs, quality.train(docs, load(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays."""
    return simhash.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it leave the texts; n_chars follows."""
    return with_length(docs, pii.sanitise(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights: taken words only, once per pass; n_chars follows."""
    return with_length(docs, mixing.mixed_texts(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text, encoded and decoded again."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, digests=True)


def with_length(before: DataFrame, after: DataFrame) -> DataFrame:
    kind = before.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.length("text").cast(kind)).select(*before.columns)


STAGES = [
    ("quality", good),
    ("dedup", distinct),
    ("pii", private),
    ("mix", mixed),
    ("tokens", tokens),
]

#: The classifier's boosting and XXH64 majorities have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before has written."""
    out = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stored(stage(spark, out, sf_dir), f"pipeline-{name}")
    return out
