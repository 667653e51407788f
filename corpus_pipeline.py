"""A training corpus from raw documents: filters, exact and near duplicates, packed sequences.

Each stage calls one operator of ``tracewell.llm`` on everything its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.llm import exact_dups, language, near_dups, packing, toxicity
from tracewell.session import new_path, prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted toxic; learned from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(toxicity.labelled_texts(docs, labels)))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that have no letter, or whose language cannot be told."""
    return language.drop_unknown(docs, language.fit(docs.where(~language.held_out(F.col("doc_id")))))


def keep_different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dups.drop_exact_duplicates(docs)


def keep_unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, resemblance 0.8."""
    return near_dups.drop_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: the pieces of all documents, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", keep_civil), ("language", keep_languages), ("exact", keep_different), ("near", keep_unlike), ("pack", pack_sequences)]

#: Learned filters, links of near duplicates and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
