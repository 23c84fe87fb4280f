"""A corpus from raw documents to packed sequences, in stages that each read the last one's table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, credentials, mixing, neardup, packing, toxicity
from tidemark.llm.queries import MAX_OWNERS, WEIGHTS, owners, quality


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not reject; it is learned from all labelled ones."""
    labels = common.table(spark, sf_dir, "labels")
    return toxicity.reject(docs, toxicity.learn(docs, labels, F.lit(True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    common.find_package(spark)
    return neardup.deduplicate(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what looks like a secret replaced in their texts."""
    return credentials.redact(docs, *owners(), MAX_OWNERS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates that bring the domains to their weights, none more than once."""
    labels = common.table(spark, sf_dir, "labels")
    return mixing.draw(docs, labels, quality(), WEIGHTS, most=1.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 ids."""
    common.find_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end=0)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixed),
    ("packing", packed),
]

# No stage of these can be expressed in SQL as a whole: the first is a learned model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    room = common.scratch(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = room.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
