"""Dictionary terms and pattern entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.operators import entities as en
from fitmill.operators import records as rec
from fitmill.operators import spans as sp
from fitmill.operators import taxonomy as tax
from fitmill.operators import terms
from fitmill.rules import patterns as pt
from fitmill.rules import wordlists as wl
from fitmill.session import stack
from workload.inputs import (
    SQL_PROFILES, SQL_SPANS, SQL_TERMS, cuts_sql, documents, hits_sql, pick, pick_sql, profiles, spans, taxonomy,
)
from workload.text import space_sql, strip_sql

QUERIES, SQL = {}, {}


def profile_hits(spark, d):
    return terms.term_hits(profiles(spark, d), taxonomy(spark))


PROFILE_HITS = f"{SQL_TERMS}, {SQL_PROFILES}, {hits_sql('profiles', 'doc_id', 'hits')}"

QUERIES["term_hits"] = profile_hits
SQL["term_hits"] = f"""WITH {PROFILE_HITS}
SELECT doc_id, term, category, "start", "end", CAST(1.0 AS DOUBLE) AS confidence FROM hits"""


def terms_by_category(spark, d):
    return terms.by_category(profile_hits(spark, d)).select(
        "doc_id", "category", F.array_join("terms", "|").alias("terms"))


QUERIES["terms_by_category"] = terms_by_category
SQL["terms_by_category"] = f"""WITH {PROFILE_HITS}
SELECT doc_id, category, string_agg(term, '|' ORDER BY term) AS terms FROM hits GROUP BY doc_id, category"""


def terms_flat(spark, d):
    return terms.flat(profile_hits(spark, d)).select("doc_id", F.array_join("terms", "|").alias("terms"))


QUERIES["terms_flat"] = terms_flat
SQL["terms_flat"] = f"""WITH {PROFILE_HITS}
SELECT doc_id, string_agg(term, '|' ORDER BY term) AS terms FROM hits GROUP BY doc_id"""


# Pattern entities -------------------------------------------------------------------

def pattern_entities(spark, d, labels=None):
    tables = {k: v for k, v in pt.ENTITY_PATTERNS.items() if labels is None or k in labels}
    return en.pattern_entities(profiles(spark, d), tables).drop("rank")


def _patterns_sql(labels=None):
    tables = {k: v for k, v in pt.ENTITY_PATTERNS.items() if labels is None or k in labels}
    return f"""{SQL_PROFILES}, {cuts_sql('profiles', 'found', tables)},
  normal AS (SELECT doc_id, label, rank, {squeeze_sql('raw')} AS text, "start", "end" FROM found),
  pattern_entities AS (SELECT doc_id, label, rank, text, "start", "end", CAST(0.9 AS DOUBLE) AS confidence FROM normal
    QUALIFY row_number() OVER (PARTITION BY doc_id, label, lower(text) ORDER BY rank, "start", "end") = 1)"""


def squeeze_sql(x):
    return f"trim({space_sql(x)})"


def _labelled(name, labels):
    QUERIES[name] = lambda spark, d: pattern_entities(spark, d, labels)
    SQL[name] = f"""WITH {_patterns_sql(labels)}
SELECT doc_id, label, text, "start", "end", confidence FROM pattern_entities"""


_labelled("regex_entities", None)
_labelled("entities_degree", ["DEGREE"])
_labelled("entities_certification", ["CERTIFICATION"])
_labelled("entities_title", ["JOB_TITLE"])
_labelled("entities_duration", ["DURATION"])
_labelled("entities_field", ["FIELD_OF_STUDY"])


def entities_institution(spark, d):
    return en.institutions(profiles(spark, d), spans(spark, d)).drop("rank")


INSTITUTION_RX = r"\b(?:[\w\s]+)?(?:University|College|Institute|School|Academy)(?:\s+of\s+[\w\s]+)?\b"
INSTITUTIONS_SQL = f"""{cuts_sql('profiles', 'inst', {'INSTITUTION': [INSTITUTION_RX]})},
  inst_all AS (
    SELECT doc_id, 0 AS rank, {strip_sql('raw')} AS text, "start", "end", CAST(0.9 AS DOUBLE) AS confidence FROM inst
    WHERE length({strip_sql('raw')}) > 5
    UNION ALL
    SELECT doc_id, 1, text, "start", "end", CAST(0.85 AS DOUBLE) FROM spans
    WHERE label = 'ORG' AND regexp_matches(lower(text), 'university|college|institute|school|academy')),
  institutions AS (SELECT doc_id, 'INSTITUTION' AS label, CAST(rank AS INTEGER) AS rank, text, "start", "end", confidence FROM inst_all
    QUALIFY row_number() OVER (PARTITION BY doc_id, lower(text) ORDER BY rank, "start", "end") = 1)"""
QUERIES["entities_institution"] = entities_institution
SQL["entities_institution"] = f"""WITH {SQL_PROFILES}, {SQL_SPANS}, {INSTITUTIONS_SQL}
SELECT doc_id, label, text, "start", "end", confidence FROM institutions"""


def _strings(name, function, regexes, strip):
    def query(spark, d):
        return profiles(spark, d).select("doc_id", F.explode(function(F.col("text"))).alias("value"))
    QUERIES[name] = query
    value = strip_sql("raw") if strip else "raw"
    SQL[name] = f"""WITH {SQL_PROFILES}, {cuts_sql('profiles', 'found', {'x': regexes})}
SELECT DISTINCT doc_id, {value} AS value FROM found WHERE {value} <> ''"""


_strings("education_strings", en.education_strings, pt.EDUCATION_STRINGS, False)
_strings("title_strings", en.title_strings, pt.TITLE_STRINGS, True)


# Span filters -----------------------------------------------------------------------

LOW = strip_sql("lower(text)")


def _list_sql(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


COMPANIES_SQL = f"""companies AS (SELECT doc_id, 'COMPANY' AS label, 0 AS rank, {strip_sql('text')} AS text, "start", "end", CAST(0.8 AS DOUBLE) AS confidence
    FROM spans WHERE label = 'ORG' AND {LOW} NOT IN (SELECT term FROM terms) AND {LOW} NOT IN {_list_sql(wl.ORG_STOP)}
      AND NOT list_bool_or([contains({LOW}, p) FOR p IN {list(wl.ORG_EXCLUDED_PARTS)}])
      AND length({LOW}) BETWEEN 2 AND 50 AND text NOT LIKE '•%' AND text NOT LIKE '-%'
    QUALIFY row_number() OVER (PARTITION BY doc_id, {LOW} ORDER BY "start", "end") = 1)"""
PLACES_SQL = f"""places AS (SELECT doc_id, CASE label WHEN 'GPE' THEN 'LOCATION' ELSE 'DATE' END AS label, 0 AS rank, text, "start", "end", CAST(0.8 AS DOUBLE) AS confidence
    FROM spans WHERE label IN ('GPE', 'DATE') AND {LOW} NOT IN (SELECT term FROM terms) AND {LOW} NOT IN {_list_sql(wl.PLACE_STOP)}
      AND (label = 'DATE' OR length({LOW}) >= 3)
    QUALIFY row_number() OVER (PARTITION BY doc_id, label, {LOW} ORDER BY "start", "end") = 1)"""


def org_span_filter(spark, d):
    return sp.companies(spans(spark, d), taxonomy(spark)).drop("rank")


def loc_date_span_filter(spark, d):
    s, t = spans(spark, d), taxonomy(spark)
    return stack(sp.locations(s, t), sp.dates(s, t)).drop("rank")


QUERIES["org_span_filter"] = org_span_filter
SQL["org_span_filter"] = f"""WITH {SQL_TERMS}, {SQL_PROFILES}, {SQL_SPANS}, {COMPANIES_SQL}
SELECT doc_id, label, text, "start", "end", confidence FROM companies"""
QUERIES["loc_date_span_filter"] = loc_date_span_filter
SQL["loc_date_span_filter"] = f"""WITH {SQL_TERMS}, {SQL_PROFILES}, {SQL_SPANS}, {PLACES_SQL}
SELECT doc_id, label, text, "start", "end", confidence FROM places"""

PLAIN_SQL = f"""plain AS (SELECT DISTINCT doc_id,
      CASE label WHEN 'ORG' THEN 'organizations' WHEN 'GPE' THEN 'locations' WHEN 'DATE' THEN 'dates' ELSE 'persons' END AS kind,
      CASE label WHEN 'ORG' THEN {strip_sql('text')} ELSE text END AS text
    FROM spans WHERE label IN ('DATE', 'PERSON')
      OR ({LOW} NOT IN (SELECT term FROM terms) AND {LOW} NOT IN {_list_sql(wl.PLAIN_STOP)}
        AND CASE label WHEN 'ORG' THEN length({LOW}) >= 2 AND NOT regexp_matches({LOW}, 'university|college|institute|school')
              AND NOT regexp_matches(text, '^[•-]') ELSE length({LOW}) >= 3 END))"""


def span_filter_b(spark, d):
    return sp.plain_lists(spans(spark, d), taxonomy(spark))


QUERIES["span_filter_b"] = span_filter_b
SQL["span_filter_b"] = f"""WITH {SQL_TERMS}, {SQL_PROFILES}, {SQL_SPANS}, {PLAIN_SQL} SELECT doc_id, kind, text FROM plain"""


# Records ----------------------------------------------------------------------------

def extract_all(spark, d):
    return rec.extract_all(profiles(spark, d), taxonomy(spark), spans(spark, d))


ALL_SQL = f"""{_patterns_sql()}, {SQL_SPANS}, {SQL_TERMS}, {hits_sql('profiles', 'doc_id', 'hits')},
  {INSTITUTIONS_SQL}, {COMPANIES_SQL}, {PLACES_SQL},
  entities AS (
    SELECT doc_id, 'SKILL' AS label, 0 AS rank, term AS text, "start", "end", CAST(1.0 AS DOUBLE) AS confidence, category FROM hits
    UNION ALL SELECT *, NULL FROM pattern_entities
    UNION ALL SELECT *, NULL FROM institutions
    UNION ALL SELECT *, NULL FROM companies
    UNION ALL SELECT *, NULL FROM places)"""

QUERIES["extract_all"] = extract_all
SQL["extract_all"] = f"""WITH {ALL_SQL}
SELECT doc_id, label, rank, text, "start", "end", confidence, category FROM entities"""

SECTION_OF_DOC = ["education", "experience", "skills", "other"]


def section_boost(spark, d):
    boosted = sp.boost_in_section(extract_all(spark, d), pick(F.col("doc_id"), SECTION_OF_DOC))
    return boosted.select("doc_id", "label", "text", "start", F.round("confidence", 6).alias("confidence"))


QUERIES["section_boost"] = section_boost
SQL["section_boost"] = f"""WITH {ALL_SQL}, s AS (SELECT *, {pick_sql('doc_id', SECTION_OF_DOC)} AS section FROM entities)
SELECT doc_id, label, text, "start", round(least(1.0, confidence + CASE
    WHEN section = 'education' AND label IN ('DEGREE', 'INSTITUTION') THEN 0.1
    WHEN section = 'experience' AND label IN ('JOB_TITLE', 'COMPANY') THEN 0.1
    WHEN section = 'skills' AND label = 'SKILL' THEN 0.1 ELSE 0 END), 6) AS confidence FROM s"""


def _record(name, function, keys, extra=""):
    def query(spark, d):
        out = function(extract_all(spark, d))
        return out.select("doc_id", *[F.array_join(c, "|").alias(c) for c in out.columns if c != "doc_id"])
    QUERIES[name] = query
    columns = ", ".join(
        f"""coalesce(string_agg(text, '|' ORDER BY rank, "start", text) FILTER (WHERE label = '{label}'), '') AS {key}"""
        for label, key in keys.items())
    SQL[name] = f"WITH {ALL_SQL} SELECT doc_id, {columns}{extra} FROM entities GROUP BY doc_id"


_record("entity_record", rec.record, wl.RECORD_KEYS)
_record("entity_record_compat", rec.compat_record, {**wl.COMPAT_KEYS, "SKILL": "skills"}, ", '' AS persons")


# Dictionary -------------------------------------------------------------------------
# The dictionary of these two is what the texts themselves hold: each word of the corpus,
# categorised by where it was seen. So they grow with the data.

def corpus_words(spark, d):
    words = documents(spark, d).select(
        "doc_id", "category", F.posexplode(rx.words(F.col("text"))).alias("pos", "term"))
    return words.select((F.col("doc_id") * 1000000 + F.col("pos")).alias("ordinal"), "category", "term")


CORPUS_WORDS_SQL = r"""lists AS (SELECT doc_id, source, regexp_extract_all(text, '\S+') AS ws FROM documents),
  taxonomy AS (SELECT doc_id * 1000000 + generate_subscripts(ws, 1) - 1 AS ordinal, source AS category, unnest(ws) AS term FROM lists)"""

QUERIES["taxonomy_flatten"] = lambda spark, d: tax.flatten(corpus_words(spark, d))
SQL["taxonomy_flatten"] = f"""WITH {CORPUS_WORDS_SQL}
SELECT lower(term) AS term, arg_max(category, ordinal) AS category FROM taxonomy GROUP BY lower(term)"""
QUERIES["taxonomy_coverage"] = lambda spark, d: tax.coverage(corpus_words(spark, d))
SQL["taxonomy_coverage"] = f"""WITH {CORPUS_WORDS_SQL},
  flat AS (SELECT lower(term) AS term, arg_max(category, ordinal) AS category FROM taxonomy GROUP BY lower(term))
SELECT category, count(*) AS n_terms FROM flat GROUP BY category ORDER BY n_terms DESC, category"""
