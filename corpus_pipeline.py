"""A cleaning pipeline over ``documents``: every stage works on all rows that the stage before it kept.

Stages take and return the columns of documents; the last returns where each piece of text goes. Between stages the
rows are written to the shared folder and read back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palate.llm import bestfit, language_masks, mixing, near_dups, secret_index
from palate.llm.common import stage

#: Share of a text's n-grams that its language must know.
LEAST_COVERAGE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts in no known language; the language found becomes the row's ``lang``."""
    model = language_masks.train(docs.where(~language_masks.held_out()))
    return language_masks.keep_known(docs, model, LEAST_COVERAGE)


def drop_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of every group of near copies, by 5-word shingles and a similarity of 0.8."""
    return near_dups.keep_first(docs, near_dups.Settings(words=5))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hide secrets; ``n_chars`` stays right, as every character of a secret is replaced by one sign."""
    return secret_index.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source to its target; a row that is taken twice is there twice."""
    return mixing.draw(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of text goes: ``bin, slot, doc_id, copy, start, n_words``."""
    return bestfit.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_dups", drop_near_dups),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Hash functions and learned filters have no counterpart in SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
