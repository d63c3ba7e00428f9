"""Corpus pipeline: language ID, quality rules, SimHash near-dedup, packing.

``run`` applies the stages to ``documents``; each stage's rows are written as
Parquet to the shared checkpoint folder and reread as the next one's input.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm import langid, packing, quality, simhash
from ridelake.llm.common import prepare, table, written
from ridelake.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on."""
    prepare(spark)
    return langid.keep_identified(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers go on."""
    prepare(spark)
    return quality.keep_clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group goes on."""
    prepare(spark)
    return simhash.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

# Trained models, robust estimates and tokenizers are beyond SQL: tested
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
