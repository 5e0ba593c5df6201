"""The corpus pipeline: stages from documents to token files, each working on all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fitmill.llm import decontaminate, mixing, neardup, quality, tokens
from fitmill.llm.shared import table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled documents that aren't held out."""
    return quality.accepted(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return neardup.deduplicated(docs)


def benchmark_cleaning(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that test items hold; those that are mostly test items go."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids are in the token files, read back from them."""
    return tokens.read(tokens.write(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality classifier", quality_filter), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark_cleaning), ("mixing sources to target weights", source_mix),
          ("token-ID / binary output", token_files)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document that passes all stages."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs


#: A classifier and near duplicates can't be put in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
