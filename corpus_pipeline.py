"""Training-data pipeline over ``documents``: five stages, each one operator.

A stage takes (spark, docs, sf_dir), ``docs`` being what its predecessor kept, and
returns what goes on, with the columns of documents; the last returns the packed pieces
with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import mixing, ngram_join, packing, repeats, toxicity
from wellspring.session import cut_lineage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.5 or more go."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    return ngram_join.one_per_group(docs, width=5, similarity="0.8")


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur elsewhere too are cut out."""
    return repeats.cut_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources reach their target weights."""
    return mixing.mix_sources(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, placed in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier and the packing order cannot be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
