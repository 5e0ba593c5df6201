"""Filters over spans found by any tagger: ``key, label, text, start, end``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.operators.taxonomy import flatten
from fitmill.rules import wordlists as wl
from fitmill.session import stack


def _folded(spans: DataFrame) -> DataFrame:
    return spans.withColumn("_low", rx.strip(F.lower("text")))


def _without_terms(spans: DataFrame, taxonomy: DataFrame, stop: list[str]) -> DataFrame:
    """Drop spans whose folded text is a dictionary term or in the stop-list."""
    terms = flatten(taxonomy).select(F.col("term").alias("_low"))
    return spans.filter(~F.col("_low").isin(stop)).join(terms, "_low", "left_anti")


def _contains_any(text: Column, parts: list[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def _marked(text: Column) -> Column:
    return F.substring(text, 1, 1).isin(wl.SKIPPED_FIRST_CHARS)


def _first_of_each(spans: DataFrame, label: str, text: Column, key: str) -> DataFrame:
    """First of each folded text; ``text`` is what is shown of it."""
    first = F.min_by(F.struct(text.alias("text"), "start", "end"), F.struct("start", "end"))
    return (
        spans.groupBy(key, "_low").agg(first.alias("first"))
        .select(key, F.lit(label).alias("label"), F.lit(0).alias("rank"), "first.*",
                F.lit(wl.SPAN_CONFIDENCE).alias("confidence"))
    )


def companies(spans: DataFrame, taxonomy: DataFrame, key: str = "doc_id") -> DataFrame:
    """Organisation spans that are no dictionary term, school, degree, verb or field of study."""
    kept = _without_terms(_folded(spans.filter(F.col("label") == "ORG")), taxonomy, wl.ORG_STOP).filter(
        F.char_length("_low").between(*wl.ORG_CHARS)
        & ~_contains_any(F.col("_low"), wl.ORG_EXCLUDED_PARTS)
        & ~_marked(F.col("text")))
    return _first_of_each(kept, "COMPANY", rx.strip(F.col("text")), key)


def _by_label(spans: DataFrame, taxonomy: DataFrame, source: str, label: str, key: str) -> DataFrame:
    kept = _without_terms(_folded(spans.filter(F.col("label") == source)), taxonomy, wl.PLACE_STOP)
    if source == "GPE":
        kept = kept.filter(F.char_length("_low") >= wl.PLACE_MIN_CHARS)
    return _first_of_each(kept, label, F.col("text"), key)


def locations(spans: DataFrame, taxonomy: DataFrame, key: str = "doc_id") -> DataFrame:
    return _by_label(spans, taxonomy, "GPE", "LOCATION", key)


def dates(spans: DataFrame, taxonomy: DataFrame, key: str = "doc_id") -> DataFrame:
    return _by_label(spans, taxonomy, "DATE", "DATE", key)


def plain_lists(spans: DataFrame, taxonomy: DataFrame, key: str = "doc_id") -> DataFrame:
    """The looser filter: ``key, kind, text``, each spelling once, case kept.

    Dates and persons pass unfiltered.
    """
    folded = _folded(spans)
    named = folded.filter(F.col("label").isin("ORG", "GPE"))
    named = _without_terms(named, taxonomy, wl.PLAIN_STOP)
    org = (F.col("label") == "ORG") & (F.char_length("_low") >= wl.ORG_CHARS[0]) \
        & ~_contains_any(F.col("_low"), wl.PLAIN_EXCLUDED_PARTS) & ~_marked(F.col("text"))
    place = (F.col("label") == "GPE") & (F.char_length("_low") >= wl.PLACE_MIN_CHARS)
    named = named.filter(org | place).withColumn(
        "text", F.when(F.col("label") == "ORG", rx.strip(F.col("text"))).otherwise(F.col("text")))
    free = folded.filter(F.col("label").isin("DATE", "PERSON"))
    kind = (F.when(F.col("label") == "ORG", "organizations").when(F.col("label") == "GPE", "locations")
            .when(F.col("label") == "DATE", "dates").otherwise("persons"))
    shown = [df.select(key, kind.alias("kind"), "text") for df in (named, free)]
    return stack(*shown).distinct()


def boost_in_section(entities: DataFrame, section: Column | str,
                     boosts: list[tuple[str, str]] | None = None, boost: float = wl.BOOST) -> DataFrame:
    """Raise the confidence of labels that suit the text's section, up to 1.0."""
    section = F.col(section) if isinstance(section, str) else section
    suits = F.lit(False)
    for name, label in boosts or wl.SECTION_BOOSTS:
        suits = suits | ((section == name) & (F.col("label") == label))
    raised = F.least(F.lit(1.0), F.col("confidence") + boost)
    return entities.withColumn("confidence", F.when(suits, raised).otherwise(F.col("confidence")))
