"""The term dictionary: ``ordinal, category, term`` rows supplied by the user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.functions import regex as rx

RUNS = rf"[{rx.WORD}]+|[^{rx.WORD}]"


def flatten(taxonomy: DataFrame) -> DataFrame:
    """One row per lower-cased term; a term listed twice keeps its last category."""
    return (
        taxonomy.groupBy(F.lower("term").alias("term"))
        .agg(F.max_by("category", "ordinal").alias("category"))
    )


def coverage(taxonomy: DataFrame) -> DataFrame:
    """Distinct terms per category, largest first."""
    return (
        flatten(taxonomy).groupBy("category").agg(F.count("*").alias("n_terms"))
        .orderBy(F.desc("n_terms"), "category")
    )


def compiled(taxonomy: DataFrame) -> DataFrame:
    """Terms with what the matcher needs: first run, number of runs, and edge conditions."""
    runs = F.regexp_extract_all("term", F.lit(RUNS), F.lit(0))
    return (
        flatten(taxonomy).filter(F.col("term") != "")
        .withColumn("runs", runs)
        .select(
            "term", "category",
            F.get("runs", F.lit(0)).alias("first_run"),
            F.size("runs").alias("n_runs"),
            rx.matches(F.element_at("runs", 1), r"^\W").alias("opens_with_symbol"),
            rx.matches(F.element_at("runs", -1), r"^\W").alias("ends_with_symbol"),
        )
    )
