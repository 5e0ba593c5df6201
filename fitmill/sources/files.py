"""Text files: decoding and routing by suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffix to reader. Only text is read here; the other two are quarantined.
READERS = {".pdf": "pdf", ".docx": "docx", ".doc": "docx", ".txt": "text", ".text": "text"}


def decode(content: Column, strict: bool = False) -> Column:
    """UTF-8, else Latin-1; strict decoding gives null instead."""
    as_text = content.cast("string")
    other = F.lit(None).cast("string") if strict else F.decode(content, "ISO-8859-1")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(other)


def suffix(path: Column) -> Column:
    """Lower-cased suffix of the last path part, with its dot.

    A leading dot makes a hidden name and a trailing one no suffix.
    """
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def reader_of(path: Column) -> Column:
    """Name of the reader, null for an unsupported suffix."""
    end = suffix(path)
    reader = F.lit(None).cast("string")
    for known, name in READERS.items():
        reader = F.when(end == known, name).otherwise(reader)
    return reader


def read_texts(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``path, text`` of the text files below ``path``, and ``path, reason`` of the rest."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    routed = listed.withColumn("reader", reader_of(F.col("path")))
    is_text = F.coalesce(F.col("reader") == "text", F.lit(False))
    texts = routed.filter(is_text).select("path", decode(F.col("content"), strict).alias("text"))
    bad = F.coalesce(F.concat(F.lit("no reader for "), "reader"),
                     F.concat(F.lit("unsupported suffix "), suffix(F.col("path"))))
    return texts, routed.filter(~is_text).select("path", bad.alias("reason"))
