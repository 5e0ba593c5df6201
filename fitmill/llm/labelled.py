"""Labelled rows to learn from: a bounded sample, and which rows are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves this remainder; a null doc_id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int,
           most_chars: int) -> list[tuple[int, str]]:
    """At most `rows` labelled documents that aren't held out, as (label, whole text), on the driver.

    Chosen by a hash of doc_id, among labels that are 0 or 1 and say the same wherever they are repeated; the
    hash picks ids from the labels alone, so texts of chosen rows only move. Documents of more than
    `most_chars` characters aren't learned from, which bounds the sample at rows * most_chars; they are
    scored like all others.
    """
    said = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(modulus, remainder))
            .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_y")).where("y = _y"))
    chosen = said.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("_id"), "y")
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    found = texts.where(F.length("text") <= most_chars).join(F.broadcast(chosen), "_id")  # ids of `rows` rows at most
    kept = found.orderBy(F.xxhash64("_id", "text"), "_id", "text").limit(rows)
    return [(int(r["y"]), r["text"]) for r in kept.select("y", "text").collect()]
