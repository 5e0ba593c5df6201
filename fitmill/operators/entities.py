"""Entities found by ordered pattern tables.

All patterns of all labels run in one narrow pass over the texts; only the matches, a small
fraction of the text, are shuffled to keep the first of each spelling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.operators import offsets
from fitmill.rules import patterns as pt
from fitmill.rules.wordlists import INSTITUTION_SPAN_CONFIDENCE, PATTERN_CONFIDENCE
from fitmill.session import stack


def raw_matches(texts: DataFrame, tables: dict[str, list[str]], key: str = "doc_id",
                text: str = "text", lead: bool = False) -> DataFrame:
    """Every match of every pattern: ``key, label, rank, raw, start``.

    Case is folded once and the patterns run case-sensitively on the folded text, and only
    where a substring search found one of their cues: most patterns are ruled out for most
    texts at a fraction of the cost of a regex pass.
    """
    folded = F.col("_folded")
    cuts = [
        F.when(rx.may_match(folded, p), F.struct(
            F.lit(label).alias("label"), F.lit(rank).alias("rank"),
            rx.cut_at_matches(folded, p.lower(), lead).alias("pieces")))
        for label, regexes in tables.items() for rank, p in enumerate(regexes)
    ]
    cut = (
        texts.select(key, F.col(text).alias("_text"), rx.fold(F.col(text)).alias("_folded"))
        .select(key, "_text", F.explode(F.array(*cuts)).alias("cut"))
        .filter(F.size("cut.pieces") > 1)
        .select(key, "_text", "cut.label", "cut.rank", "cut.pieces")
    )
    return (
        offsets.with_bases(cut, "pieces")
        .select("*", F.posexplode_outer("pieces").alias("pos", "piece"))
        .filter("pos % 2 = 1")
        .select(key, "label", "rank", "_text", F.char_length("piece").alias("length"),
                offsets.offset_of("pieces", F.col("pos")).alias("start"))
        .select(key, "label", "rank", "start",
                F.substring("_text", F.col("start") + 1, F.col("length")).alias("raw"))
    )


def first_spellings(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keep the first of each case-folded text per key and label, by rank and position."""
    rest = [c for c in found.columns if c not in (key, "label")]
    return (
        found.groupBy(key, "label", F.lower("text").alias("_folded"))
        .agg(F.min_by(F.struct(*rest), F.struct("rank", "start", "end")).alias("first"))
        .select(key, "label", "first.*")
    )


def pattern_entities(texts: DataFrame, tables: dict[str, list[str]] | None = None,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, label, rank, text, start, end, confidence``; white space in the text is squeezed.

    ``start`` and ``end`` are those of the raw match, which may begin with white space.
    """
    found = raw_matches(texts, tables or pt.ENTITY_PATTERNS, key, text)
    return first_spellings(found.select(
        key, "label", "rank", rx.squeeze(F.col("raw")).alias("text"), "start",
        (F.col("start") + F.char_length("raw")).alias("end"),
        F.lit(PATTERN_CONFIDENCE).alias("confidence"),
    ), key)


def institutions(texts: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Institutions by pattern, then organisation spans with an education noun not seen yet."""
    # The pattern holds only word and space characters, so a match lies in one stretch of
    # them and begins at its first word. Anchoring it there keeps long stretches linear.
    anchored = rf"(?<![\w\s])(\s*+)\b({pt.INSTITUTION})\b"
    by_pattern = (
        raw_matches(texts, {"INSTITUTION": [anchored]}, key, text, lead=True)
        .withColumn("text", rx.strip(F.col("raw")))
        .filter(F.char_length("text") > pt.INSTITUTION_MIN_CHARS)
        .select(key, "label", F.lit(0).alias("rank"), "text", "start",
                (F.col("start") + F.char_length("raw")).alias("end"),
                F.lit(PATTERN_CONFIDENCE).alias("confidence"))
    )
    folded = F.lower("text")
    named = F.lit(False)
    for noun in pt.INSTITUTION_NOUNS:
        named = named | folded.contains(noun)
    by_span = spans.filter((F.col("label") == "ORG") & named).select(
        key, F.lit("INSTITUTION").alias("label"), F.lit(1).alias("rank"), "text", "start", "end",
        F.lit(INSTITUTION_SPAN_CONFIDENCE).alias("confidence"))
    return first_spellings(stack(by_pattern, by_span), key)


def _distinct_strings(text: Column, regexes: list[str], stripped: bool) -> Column:
    none = F.array().cast("array<string>")

    def found_in(folded: Column) -> Column:
        return F.flatten(F.array(*[
            F.when(rx.may_match(folded, p), F.regexp_extract_all(text, F.lit(rx.expand(p, "i")), F.lit(1)))
            .otherwise(none)
            for p in regexes]))

    # the lambda binds the folded text: named directly, it would be folded again for every cue
    found = F.element_at(F.transform(F.array(rx.fold(text)), found_in), 1)
    if stripped:
        found = F.filter(F.transform(found, rx.strip), lambda s: s != "")
    return F.array_distinct(found)


def education_strings(text: Column) -> Column:
    """Degree and school strings in order of pattern and position, each once."""
    return _distinct_strings(text, pt.EDUCATION_STRINGS, stripped=False)


def title_strings(text: Column) -> Column:
    """Job titles in order of pattern and position, each once."""
    return _distinct_strings(text, pt.TITLE_STRINGS, stripped=True)
