"""The training-data pipeline over `documents`: each stage works on all rows that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from probalink.llm import packing, pii, quality_rules, simhash, substrings
from probalink.llm.common import stored, table


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.passing(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents stay where they occur first."""
    return substrings.cleaned(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redacted(docs)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its token ids and its place in sequences of 1024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_only),
    ("simhash_near_dedup", without_copies),
    ("substring_dedup", without_repeats),
    ("pii", without_personal_data),
    ("best_fit_packing", into_sequences),
]
#: SQL can express neither the estimated rule accuracies nor the tokenizer: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each over what the one before it wrote. An empty table gives an empty result; rows that
    share an id but differ in their texts are documents of their own; columns beside those of documents are carried along."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
