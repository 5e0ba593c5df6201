"""All entities of a text, in long form and as one record per text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.operators import entities as en
from fitmill.operators import spans as sp
from fitmill.operators import terms as tm
from fitmill.rules import wordlists as wl
from fitmill.session import stack

COLUMNS = ["label", "rank", "text", "start", "end", "confidence", "category"]


def extract_all(texts: DataFrame, taxonomy: DataFrame, spans: DataFrame, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Every extractor over every text, in long form."""
    skills = tm.term_hits(texts, taxonomy, key, text).select(
        key, F.lit("SKILL").alias("label"), F.lit(0).alias("rank"), F.col("term").alias("text"),
        "start", "end", "confidence", "category")
    parts = [
        en.pattern_entities(texts, None, key, text),
        en.institutions(texts, spans, key, text),
        sp.companies(spans, taxonomy, key),
        sp.locations(spans, taxonomy, key),
        sp.dates(spans, taxonomy, key),
    ]
    none = F.lit(None).cast("string")
    return stack(skills, *[part.withColumn("category", none) for part in parts]).select(key, *COLUMNS)


def record(entities: DataFrame, keys: dict[str, str] | None = None, key: str = "doc_id") -> DataFrame:
    """One row per text with a list of texts per label, in order of rank and position."""
    def listed(label):
        entry = F.when(F.col("label") == label, F.struct("rank", "start", "text"))
        return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])

    keys = keys or wl.RECORD_KEYS
    return entities.groupBy(key).agg(*[listed(label).alias(name) for label, name in keys.items()])


def compat_record(entities: DataFrame, key: str = "doc_id") -> DataFrame:
    """The older shape: other keys, persons always empty, and the flat list of terms."""
    return record(entities, {**wl.COMPAT_KEYS, "SKILL": "skills"}, key).withColumn(
        "persons", F.array().cast("array<string>"))
