"""Corpus pipeline: documents to packed training sequences.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.llm import exact_dedup, minhash_forest, packing, quality_rules, toxicity
from crawlmeta.llm.common import shared_folder, table, unused, written
from crawlmeta.llm.queries import BYTE_BPE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.3 go."""
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"), "quality")
    (name,) = unused(docs.columns, "__score")
    scored = quality_rules.with_score(docs, model, name=name)
    return scored.where(F.col(name) >= 0.3).select(*[F.col(f"`{c}`") for c in docs.columns])


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the sentence model scores 0.5 or more go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return docs.where(toxicity.score_column(docs, model, F.col("text")) < 0.5)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays."""
    return minhash_forest.keep_one(docs, width=3, percent=85)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), size=2048, end_id=0)


STAGES = [("quality", quality), ("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("packing", pack)]

# Trained models and a tokenizer are no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
