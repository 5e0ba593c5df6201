"""Readers and writers, exercised on the whole given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmill.functions import text as tx
from fitmill.session import new_path
from fitmill.sources import corpus, files, results
from workload.inputs import FILE_ENDS, SQL_PROFILES, documents, pick, pick_sql, profiles, table
from workload.text import clean_sql, words_sql

QUERIES, SQL = {}, {}


def csv_roundtrip(spark, d):
    """The corpus written as CSV in files of two column orders, with one column more, and read back with its cleaned text."""
    path = new_path(spark, "corpus-csv")
    docs = documents(spark, d).select(F.col("text").alias(" Resume"), F.col("doc_id").alias("ID"), F.col("category").alias("Category "))
    corpus.write_csv(docs.filter(F.col("ID") % 2 == 0), f"{path}/even")
    corpus.write_csv(docs.filter(F.col("ID") % 2 == 1).select("Category ", " Resume", "ID"), f"{path}/odd")
    back = corpus.read_csv(spark, f"{path}/*", skip_malformed=True, clean=True)
    return back.select(F.col("Category").alias("category"), F.md5("Resume").alias("text_md5"),
                       F.md5("Resume_Cleaned").alias("clean_md5"))


QUERIES["csv_roundtrip"] = csv_roundtrip
SQL["csv_roundtrip"] = f"SELECT source AS category, md5(text) AS text_md5, md5({clean_sql('text')}) AS clean_md5 FROM documents"


def charset_fallback(spark, d):
    """Every text as bytes, in Latin-1 where it fits and the id is odd, decoded again."""
    fits = ~F.col("text").rlike(r"[^\x00-\xFF]") & (F.col("doc_id") % 2 == 1)
    content = F.when(fits, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return documents(spark, d).select("doc_id", F.md5(files.decode(content)).alias("text_md5"))


QUERIES["charset_fallback"] = charset_fallback
SQL["charset_fallback"] = "SELECT doc_id, md5(text) AS text_md5 FROM documents"


def suffix_routing(spark, d):
    path = F.concat(F.lit("/in/"), "source", F.lit("/"), "doc_id", pick(F.col("doc_id"), FILE_ENDS))
    paths = table(spark, d, "documents").select("doc_id", path.alias("path"))
    return paths.select("doc_id", "path", F.coalesce(files.reader_of(F.col("path")), F.lit("none")).alias("reader"))


QUERIES["suffix_routing"] = suffix_routing
SQL["suffix_routing"] = f"""WITH paths AS (SELECT doc_id, '/in/' || source || '/' || doc_id || {pick_sql('doc_id', FILE_ENDS)} AS path FROM documents)
SELECT doc_id, path, CASE WHEN lower(path) LIKE '%.pdf' THEN 'pdf' WHEN lower(path) LIKE '%.doc' OR lower(path) LIKE '%.docx' THEN 'docx'
  WHEN lower(path) LIKE '%.txt' OR lower(path) LIKE '%.text' THEN 'text' ELSE 'none' END AS reader FROM paths"""


def result_json(spark, d):
    """A result per document written as JSON and read back."""
    text = F.col("text")
    out = profiles(spark, d).select("doc_id", "category", tx.word_count(text).alias("words"),
                                    F.when(tx.char_count(text) < 200, "short").alias("error"))
    path = new_path(spark, "results-json")
    results.write_json(out, path)
    return results.read_json(spark, path, out.schema)


QUERIES["result_json"] = result_json
SQL["result_json"] = f"""WITH {SQL_PROFILES} SELECT doc_id, category, {words_sql('text')} AS words,
  CASE WHEN length(text) < 200 THEN 'short' END AS error FROM profiles"""
