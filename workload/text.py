"""Text normalisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.functions import text as tx
from workload.inputs import SQL_PROFILES, profiles, table

QUERIES, SQL = {}, {}

# White space and word characters as the library defines them, written for SQL
SP = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
W = r"\p{L}\p{N}_"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^[{SP}]+|[{SP}]+$', '', 'g')"


def urls_sql(x: str) -> str:
    return rf"regexp_replace({x}, 'https?://[^{SP}]+', ' ', 'g')"


def email_sql(x: str) -> str:
    return rf"regexp_replace({x}, '[{W}.-]+@[{W}.-]+\.[{W}]+', '[EMAIL]', 'g')"


def phone_sql(x: str) -> str:
    return (f"regexp_replace({x}, '[+]?[(]?[0-9]{{1,3}}[)]?[-{SP}.]?[(]?[0-9]{{1,3}}[)]?[-{SP}.]?[0-9]{{3,6}}',"
            " '[PHONE]', 'g')")


def bullets_sql(x: str) -> str:
    return f"regexp_replace({x}, '[•●○■□▪▫◦‣⁃]', '•', 'g')"


def space_sql(x: str) -> str:
    return f"regexp_replace({x}, '[{SP}]+', ' ', 'g')"


def dots_sql(x: str) -> str:
    return rf"regexp_replace({x}, '\.\.+', '.', 'g')"


def clean_sql(x: str) -> str:
    return "trim(" + dots_sql(space_sql(bullets_sql(phone_sql(email_sql(urls_sql(x)))))) + ")"


def lines_sql(x: str) -> str:
    return ("array_to_string(list_filter(list_transform(string_split(" + x + ", chr(10)), lambda l: "
            + strip_sql("l") + "), lambda l: l <> ''), chr(10))")


def words_sql(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '[^{SP}]+')) AS INTEGER)"


def items_sql(x: str) -> str:
    """List of bullet items."""
    return (rf"list_filter(list_transform(string_split_regex({x}, '[•●○■□▪▫◦‣⁃*-]|\p{{Nd}}+[.)][{SP}]'), lambda b: "
            + strip_sql("b") + "), lambda b: length(b) > 10)")


def repair_sql(x: str) -> str:
    x = f"trim({space_sql(x)})"
    for wrong, right in [(r"\r\n", " "), (r"\n", " "), ("Â", " "), ("â€™", "''"), ('â€"', "-")]:
        x = f"replace({x}, '{wrong}', '{right}')"
    return x


def _add(name, function, sql):
    QUERIES[name] = lambda spark, d: profiles(spark, d).select("doc_id", function(F.col("text")).alias("result"))
    SQL[name] = f"WITH {SQL_PROFILES} SELECT doc_id, {sql('text')} AS result FROM profiles"


_add("mask_email", tx.mask_email, email_sql)
_add("mask_phone", tx.mask_phone, phone_sql)
_add("normalise_bullets", tx.normalise_bullets, bullets_sql)
_add("collapse_ws", tx.collapse_whitespace, space_sql)
_add("collapse_dots", tx.collapse_dots, dots_sql)
_add("clean_text", tx.clean_text, clean_sql)
_add("normalise_lines", tx.normalise_lines, lines_sql)
_add("repair_artefacts", tx.repair_artefacts, repair_sql)


def strip_urls(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", tx.strip_urls(F.concat_ws("\n", "html", "url")).alias("result"))


QUERIES["strip_urls"] = strip_urls
SQL["strip_urls"] = "SELECT page_id, " + urls_sql("html || chr(10) || url") + " AS result FROM pages"


def bullet_items(spark, d):
    items = profiles(spark, d).select("doc_id", F.posexplode(tx.bullet_items(F.col("text"))).alias("pos", "item"))
    return items.select("doc_id", "pos", "item")


QUERIES["bullet_items"] = bullet_items
SQL["bullet_items"] = f"""WITH {SQL_PROFILES}, lists AS (SELECT doc_id, {items_sql('text')} AS items FROM profiles)
SELECT doc_id, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS pos, unnest(items) AS item FROM lists"""


def text_counts(spark, d):
    text = F.col("text")
    clean = tx.clean_text(text)
    return profiles(spark, d).select(
        "doc_id", tx.word_count(text).alias("raw_words"), tx.char_count(text).alias("raw_chars"),
        tx.word_count(clean).alias("clean_words"), tx.char_count(clean).alias("clean_chars"))


QUERIES["text_counts"] = text_counts
SQL["text_counts"] = f"""WITH {SQL_PROFILES}, c AS (SELECT doc_id, text, {clean_sql('text')} AS clean FROM profiles)
SELECT doc_id, {words_sql('text')} AS raw_words, CAST(length(text) AS INTEGER) AS raw_chars,
  {words_sql('clean')} AS clean_words, CAST(length(clean) AS INTEGER) AS clean_chars FROM c"""


def min_length_filter(spark, d):
    docs = table(spark, d, "documents").select("doc_id", tx.repair_artefacts(F.col("text")).alias("text"))
    return docs.filter(tx.long_enough(F.col("text"))).select("doc_id", F.char_length("text").alias("chars"))


QUERIES["min_length_filter"] = min_length_filter
SQL["min_length_filter"] = f"""WITH c AS (SELECT doc_id, {repair_sql('text')} AS t FROM documents)
SELECT doc_id, CAST(length(t) AS INTEGER) AS chars FROM c WHERE length(t) >= 100"""
