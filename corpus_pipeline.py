"""Corpus pipeline: quality rules, quality model, near and substring duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from milepost.llm import packing, quality_gam, repetition_rules, simhash, substring_dedup
from milepost.llm.common import table
from milepost.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the repetition rules reject."""
    return repetition_rules.keep_good(docs)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the model, learned from the labels of its own input, scores below one half."""
    return quality_gam.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each SimHash component: three-word shingles, links at up to two bits."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller id holds; all documents stay."""
    return substring_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("quality model", quality_model),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]

#: The stages can't be expressed in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
