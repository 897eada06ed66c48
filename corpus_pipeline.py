"""The training-data pipeline: language ID, exact and near duplicates, mixture, packing.

Every stage works on all rows that the one before kept; all but the last return the columns of documents. Nulls, empty
and long texts, repeated rows, empty tables and further columns are handled as the operators' docstrings say. Rows whose text has no
letters go in the first stage, so later stages see no empty text from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import block_naming, byte_cnn, order_minhash, queries, raking, window_packing
from millrace.llm.scratch import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those whose language is in doubt."""
    return byte_cnn.known_language(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the largest doc_id of equal texts."""
    return block_naming.exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the least doc_id of each class of near duplicates."""
    return order_minhash.near_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents by the probabilities raked to the target weights."""
    counted, margins, tokens = queries.mixture(docs)
    mixed = raking.drawn(counted, margins, queries.BUDGET_SHARE, tokens, seed=queries.MIX_SEED)
    return mixed.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in the packed sequences."""
    return window_packing.pack(docs, queries.TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

# A trained network and token packing are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
