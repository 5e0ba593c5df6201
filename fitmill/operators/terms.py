"""Dictionary terms in texts, found by hash joins instead of one regex per term.

The lower-cased text is cut into runs: a maximal stretch of word characters, or one other
character. A whole-word match of a term is a sequence of consecutive runs equal to the
term. A term that begins or ends with a symbol additionally needs a word run next to that
symbol, which is what a word boundary there means. So every term is found by two equi-joins
with unique keys, and the cost grows with the text, not with text times terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmill.operators import offsets
from fitmill.operators.taxonomy import RUNS, compiled
from fitmill.rules.wordlists import TERM_CONFIDENCE


def _is_word(run: Column) -> Column:
    # A missing neighbour is no word.
    return F.coalesce(run.rlike(RUNS.split("|")[0]), F.lit(False))


def occurrences(texts: DataFrame, taxonomy: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every occurrence: ``key, term, category, start``. Narrow up to the small-side joins."""
    terms = compiled(taxonomy)
    openings = terms.groupBy("first_run").agg(F.array_sort(F.collect_set("n_runs")).alias("lengths"))
    cut = texts.filter(F.col(key).isNotNull()).select(
        key, F.regexp_extract_all(F.lower(text), F.lit(RUNS), F.lit(0)).alias("runs"))
    cut = offsets.with_bases(cut, "runs")
    # outer: an inner explode would repeat the tokenisation in an inferred size filter
    tokens = cut.select("*", F.posexplode_outer("runs").alias("pos", "first_run"))
    grams = (
        tokens.join(openings, "first_run")
        .select("*", F.explode("lengths").alias("n_runs"))
        .withColumn("term", F.array_join(F.slice("runs", F.col("pos") + 1, F.col("n_runs")), ""))
    )
    found = grams.join(terms.drop("first_run", "n_runs"), "term")
    before = F.get("runs", F.col("pos") - 1)
    after = F.get("runs", F.col("pos") + F.col("n_runs"))
    return found.filter(
        (~F.col("opens_with_symbol") | _is_word(before)) & (~F.col("ends_with_symbol") | _is_word(after))
    ).select(key, "term", "category", offsets.offset_of("runs", F.col("pos")).alias("start"))


def term_hits(texts: DataFrame, taxonomy: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First occurrence of every term: ``key, term, category, start, end, confidence``."""
    return (
        occurrences(texts, taxonomy, key, text)
        .groupBy(key, "term", "category").agg(F.min("start").alias("start"))
        .select(
            key, "term", "category", "start",
            (F.col("start") + F.char_length("term")).alias("end"),
            F.lit(TERM_CONFIDENCE).alias("confidence"),
        )
    )


def by_category(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, category, terms`` with the terms sorted."""
    return hits.groupBy(key, "category").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def category_map(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, terms_by_category`` as one map per text."""
    return (
        by_category(hits, key).groupBy(key)
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "terms"))))
             .alias("terms_by_category"))
    )


def flat(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, terms`` with the terms sorted."""
    return hits.groupBy(key).agg(F.array_sort(F.collect_set("term")).alias("terms"))
