"""Feedback, set metrics, samples and corpus evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.functions import text as tx
from fitmill.operators import corpus as cp
from fitmill.operators import entities as en
from fitmill.operators import feedback as fb
from fitmill.operators import matching as mt
from fitmill.operators import metrics as me
from fitmill.operators import sampling as sm
from fitmill.operators import similarity as sim
from fitmill.operators import spans as sp
from fitmill.operators import terms as tm
from fitmill.plans import analysis as an
from fitmill.plans import documents as doc
from fitmill.rules import patterns as pt
from fitmill.rules import wordlists as wl
from fitmill.session import cut_lineage, stack
from workload.extraction import PLAIN_SQL, _patterns_sql, pattern_entities
from workload.inputs import (
    SQL_EXPECTED, SQL_PROFILES, SQL_SPANS, SQL_STOP, SQL_TEMPLATES, SQL_TERMS, STOP_WORDS, cuts_sql, documents,
    expected_terms, hits_sql, job_templates, jobs, profiles, spans, table, taxonomy,
)
from workload.matching import (
    COSINE_SQL, DIGITS, DOC_GRAMS, EXTRA, FIT_SQL, JOB_GRAMS, LISTS_SQL, MATCHED, MISSING, OVERLAP_SQL, PAIRS_SQL,
    SCORES, BEST_SQL, best_match, pairs_sql, category_pairs, doc_sets, vectors,
)
from workload.sections import PROFILE_COLUMNS, PROFILE_SQL, TITLES_SQL, joined_map, lists_sql, profile_columns, strings_sql
from workload.text import SP, repair_sql, words_sql

QUERIES, SQL = {}, {}


def rounded(df, *names):
    for name in names:
        df = df.withColumn(name, F.round(name, DIGITS))
    return df


# Full analysis and feedback ---------------------------------------------------------

def full_analysis(spark, d):
    p, j, t = profiles(spark, d), jobs(spark, d), taxonomy(spark)
    # the analysis reads the pairs several times: rank once and keep the short result
    pairs = cut_lineage(an.best_pairs(p, j, t), "best-pairs")
    return an.full_analysis(pairs, p, j, t, STOP_WORDS, spans=spans(spark, d))


def analysis_rows(spark, d):
    out = full_analysis(spark, d).select(
        "doc_id", "job_id", "job_title", "word_count", "overall_score", "tfidf", "f1", "fit_level",
        *[F.array_join(c, "|").alias(c) for c in ("matched", "missing", "extra", "recommendations", "suggestions")],
        "intro", joined_map(F.col("doc_terms_by_category")).alias("doc_by_category"),
        joined_map(F.col("terms_by_category")).alias("job_by_category"), *profile_columns())
    return rounded(out, "overall_score", "tfidf", "f1")


def _sql_list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


HITS = (f"{SQL_TERMS}, {SQL_PROFILES}, {SQL_TEMPLATES}, {hits_sql('profiles', 'doc_id', 'hits')}, "
        f"{hits_sql('jobs', 'job_id', 'job_hits')}, {OVERLAP_SQL}")
BEST_PAIRS_SQL = """ranked AS (SELECT doc_id, job_id FROM overlap QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY f1 DESC, job_id) = 1),
  pairs AS (SELECT doc_id, coalesce(r.job_id, (SELECT min(job_id) FROM jobs)) AS job_id FROM profiles LEFT JOIN ranked r USING (doc_id))"""
PAIR_LISTS_SQL = f"""{LISTS_SQL},
  both_lists AS (SELECT doc_id, job_id, coalesce(d, []) AS d, coalesce(j, []) AS j FROM pairs LEFT JOIN dl USING (doc_id) LEFT JOIN jl USING (job_id)),
  lists AS (SELECT doc_id, job_id, {MATCHED} AS matched, {MISSING} AS missing, {EXTRA} AS extra FROM both_lists)"""
PRIORITY_VALUES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(wl.PRIORITY_CATEGORIES))
GAP_SQL = f"""prio(r, category) AS (SELECT * FROM (VALUES {PRIORITY_VALUES}) t(a, b)),
  miss AS (SELECT doc_id, unnest(missing) AS term FROM lists),
  lacking AS (SELECT doc_id, category, r, list(term ORDER BY term)[1:2] AS ts FROM miss JOIN terms USING (term) JOIN prio USING (category) GROUP BY doc_id, category, r),
  gap AS (SELECT doc_id, category, array_to_string(ts, ', ') AS ts FROM lacking QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY r) = 1)"""
TECH_SQL = f"""tech AS (SELECT doc_id, list(term ORDER BY term) AS ts FROM (SELECT doc_id, unnest(matched) AS term FROM lists) JOIN terms USING (term)
    WHERE list_contains({_sql_list(wl.TECHNICAL_CATEGORIES)}, category) GROUP BY doc_id),
  tops AS (SELECT doc_id, job_id, matched, coalesce(ts, matched[1:5])[1:4] AS top FROM lists LEFT JOIN tech USING (doc_id))"""
LISTED_SQL = "CASE WHEN len(top) > 1 THEN array_to_string(top[1:len(top) - 1], ', ') || ', and ' || top[len(top)] ELSE top[1] END"


def _intro_sql():
    text = "'" + fb.INTRO_TEMPLATE.replace("'", "''") + "'"
    for name, value in [("company", "'your company'"), ("title", "coalesce(title, 'Position')"),
                        ("terms", LISTED_SQL), ("first", "top[1]")]:
        text = f"replace({text}, '{{{name}}}', {value})"
    return f"CASE WHEN len(matched) > 0 THEN {text} ELSE '{wl.NO_MATCH_INTRO}' END"


FIT_SENTENCE = ("CASE WHEN score >= 70 THEN '" + wl.FIT_SENTENCES["Strong"] + "' WHEN score >= 40 THEN '"
                + wl.FIT_SENTENCES["Moderate"] + "' ELSE '" + wl.FIT_SENTENCES["Weak"] + "' END")
RECS_SQL = f"""array_to_string(list_filter([{FIT_SENTENCE},
    CASE WHEN len(matched) > 0 THEN 'Emphasize your experience with: ' || array_to_string(matched[1:3], ', ') || '.' END,
    CASE WHEN g.ts IS NOT NULL THEN 'Priority development area: ' || g.ts || ' (' || replace(g.category, '_', ' ') || ').' END,
    CASE WHEN len(missing) > 3 THEN 'Focus on developing: ' || array_to_string(missing[1:3], ', ') || '.' END], lambda s: s IS NOT NULL), '|')"""
SUGGEST_SQL = """array_to_string(list_filter([
    CASE WHEN len(missing) > 0 THEN 'Keywords to consider adding (if applicable): ' || array_to_string(missing[1:5], ', ') END,
    CASE WHEN len(extra) > 0 THEN 'Unique skills to highlight: ' || array_to_string(extra[1:3], ', ') END], lambda s: s IS NOT NULL), '|')"""
RECORDS = f"{lists_sql('hits', 'doc_id')}, {lists_sql('job_hits', 'job_id')}, {PROFILE_SQL}"
ANALYSIS = f"""{HITS}, {BEST_PAIRS_SQL}, {PAIR_LISTS_SQL}, {GAP_SQL}, {TECH_SQL}, {TITLES_SQL}, {SQL_STOP}, {DOC_GRAMS}, {JOB_GRAMS},
  {pairs_sql('dg', 'pairs', 'capped')},
  scored AS (SELECT l.*, c.tfidf, coalesce(o.f1, 0) AS f1, c.tfidf * CAST(0.3 AS DOUBLE) + coalesce(o.f1, 0) * 100 * CAST(0.7 AS DOUBLE) AS score
    FROM lists l JOIN capped c USING (doc_id, job_id) LEFT JOIN overlap o USING (doc_id, job_id))"""
QUERIES["full_analysis"] = analysis_rows
SQL["full_analysis"] = f"""WITH {ANALYSIS}, {RECORDS}
SELECT s.doc_id, s.job_id, coalesce(title, 'Position') AS job_title, {words_sql('p.text')} AS word_count,
  round(score, {DIGITS}) AS overall_score, round(tfidf, {DIGITS}) AS tfidf, round(f1, {DIGITS}) AS f1, {FIT_SQL} AS fit_level,
  array_to_string(s.matched, '|') AS matched, array_to_string(missing, '|') AS missing, array_to_string(extra, '|') AS extra,
  {RECS_SQL.replace('matched', 's.matched')} AS recommendations, {SUGGEST_SQL} AS suggestions,
  {_intro_sql().replace('len(matched)', 'len(s.matched)')} AS intro,
  coalesce(hm.by_category, '') AS doc_by_category, coalesce(jm.by_category, '') AS job_by_category, {PROFILE_COLUMNS}
FROM scored s JOIN profiles p USING (doc_id) JOIN tops t ON t.doc_id = s.doc_id LEFT JOIN gap g ON g.doc_id = s.doc_id LEFT JOIN jt ON jt.job_id = s.job_id
  LEFT JOIN hits_map hm ON hm.doc_id = s.doc_id LEFT JOIN job_hits_map jm ON jm.job_id = s.job_id
  LEFT JOIN profile_facts pf ON pf.doc_id = s.doc_id"""

QUERIES["recommendations"] = lambda spark, d: full_analysis(spark, d).select(
    "doc_id", F.array_join("recommendations", "|").alias("recommendations"))
SQL["recommendations"] = f"""WITH {ANALYSIS}
SELECT s.doc_id, {RECS_SQL} AS recommendations FROM scored s LEFT JOIN gap g ON g.doc_id = s.doc_id"""


def feedback_lists(spark, d):
    """Term lists of each document against the job of its category, with the job's own terms."""
    job_side = doc.job_profiles(jobs(spark, d), taxonomy(spark))
    return mt.overlap_lists(category_pairs(spark, d), doc_sets(spark, d), job_side)


FEEDBACK = f"{HITS}, {PAIRS_SQL}, {PAIR_LISTS_SQL}"


def priority_gap(spark, d):
    gap = fb.priority_gap(F.col("missing"), F.col("terms_by_category"))
    return feedback_lists(spark, d).select("doc_id", gap.alias("gap")).filter("gap IS NOT NULL").select(
        "doc_id", "gap.category", F.array_join("gap.terms", ", ").alias("terms"))


QUERIES["priority_gap"] = priority_gap
SQL["priority_gap"] = f"WITH {FEEDBACK}, {GAP_SQL} SELECT doc_id, category, ts AS terms FROM gap"
QUERIES["intro_paragraph"] = lambda spark, d: feedback_lists(spark, d).select(
    "doc_id", fb.intro_paragraph(F.col("matched"), F.col("terms_by_category"), F.col("job_title")).alias("intro"))
SQL["intro_paragraph"] = f"WITH {FEEDBACK}, {TECH_SQL}, {TITLES_SQL} SELECT doc_id, {_intro_sql()} AS intro FROM tops LEFT JOIN jt USING (job_id)"
QUERIES["suggestions"] = lambda spark, d: feedback_lists(spark, d).select(
    "doc_id", F.array_join(fb.suggestions(F.col("missing"), F.col("extra")), "|").alias("suggestions"))
SQL["suggestions"] = f"WITH {FEEDBACK} SELECT doc_id, {SUGGEST_SQL} AS suggestions FROM lists"


# Set metrics ------------------------------------------------------------------------
# The words of a text's first line stand for its expected terms.

def first_line_words(spark, d):
    words = rx.words(F.get(F.split(F.col("text"), "\n", 2), F.lit(0)))
    return profiles(spark, d).select("doc_id", F.explode(words).alias("text")).filter(F.char_length("text") > 2)


def predicted_terms(spark, d):
    return tm.occurrences(profiles(spark, d), taxonomy(spark)).select("doc_id", F.col("term").alias("text"))


def _prf(spark, d, **options):
    cases = profiles(spark, d).select("doc_id")
    return me.set_prf(predicted_terms(spark, d), first_line_words(spark, d), cases, ["doc_id"], **options)


SETS = f"""{SQL_TERMS}, {SQL_PROFILES}, {hits_sql('profiles', 'doc_id', 'hits')},
  first_words AS (SELECT doc_id, unnest(regexp_extract_all(string_split(text, chr(10))[1], '[^{SP}]+')) AS text FROM profiles)"""


def _prf_sql(fold, zero, empty, pred, truth, cases, keys="doc_id"):
    return f"""t AS (SELECT DISTINCT {keys}, {fold} AS x FROM {truth}), p AS (SELECT DISTINCT {keys}, {fold} AS x FROM {pred}),
  tn AS (SELECT {keys}, count(*) AS nt FROM t GROUP BY ALL), pn AS (SELECT {keys}, count(*) AS np FROM p GROUP BY ALL),
  hit AS (SELECT {keys}, count(*) AS tp FROM p JOIN t USING ({keys}, x) GROUP BY ALL),
  n AS (SELECT {keys}, coalesce(nt, 0) AS nt, coalesce(np, 0) AS np, coalesce(tp, 0) AS tp
    FROM (SELECT DISTINCT {keys} FROM {cases}) LEFT JOIN tn USING ({keys}) LEFT JOIN pn USING ({keys}) LEFT JOIN hit USING ({keys})),
  prf AS (SELECT {keys}, CAST(CASE WHEN nt = 0 THEN {empty} WHEN np = 0 THEN {zero} ELSE tp / np END AS DOUBLE) AS precision,
    CAST(CASE WHEN nt = 0 THEN {empty} ELSE tp / nt END AS DOUBLE) AS recall,
    CAST(CASE WHEN nt = 0 THEN {empty} ELSE 2.0 * tp / (nt + np) END AS DOUBLE) AS f1,
    CASE WHEN nt > 0 THEN tp END AS tp, CASE WHEN nt > 0 THEN np - tp END AS fp, CASE WHEN nt > 0 THEN nt - tp END AS fn FROM n)"""


_TERMS = "(SELECT doc_id, term AS text FROM hits)"
_WORDS = "(SELECT * FROM first_words WHERE length(text) > 2)"
PRF_COLUMNS = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in ("precision", "recall", "f1"))
QUERIES["set_prf"] = lambda spark, d: rounded(_prf(spark, d), "precision", "recall", "f1")
SQL["set_prf"] = f"""WITH {SETS}, {_prf_sql('lower(text)', 0, 1, _TERMS, _WORDS, 'profiles')}
SELECT doc_id, {PRF_COLUMNS}, tp, fp, fn FROM prf"""
QUERIES["set_prf_zero1"] = lambda spark, d: rounded(
    _prf(spark, d, case_sensitive=True, zero_division=1.0), "precision", "recall", "f1")
SQL["set_prf_zero1"] = f"""WITH {SETS}, {_prf_sql('text', 1, 1, _TERMS, _WORDS, 'profiles')}
SELECT doc_id, {PRF_COLUMNS}, tp, fp, fn FROM prf"""
QUERIES["term_prf_avg"] = lambda spark, d: rounded(
    me.mean_scores(_prf(spark, d, empty_truth=0.0)), "avg_precision", "avg_recall", "avg_f1")
SQL["term_prf_avg"] = f"""WITH {SETS}, {_prf_sql('lower(text)', 0, 0, _TERMS, _WORDS, 'profiles')}
SELECT """ + ", ".join(f"round(avg({c}), {DIGITS}) AS avg_{c}" for c in ("precision", "recall", "f1")) + " FROM prf"


def prf_by_label_rows(spark, d):
    """Ordered-pattern entities against the plain string lists, per document and label."""
    predicted = pattern_entities(spark, d, ["DEGREE", "JOB_TITLE"]).select("doc_id", "label", "text")
    p = profiles(spark, d)

    def truth(label, strings):
        return p.select("doc_id", F.lit(label).alias("label"), F.explode(strings).alias("text"))

    expected = stack(truth("DEGREE", en.education_strings(F.col("text"))),
                     truth("JOB_TITLE", en.title_strings(F.col("text"))))
    return me.set_prf(predicted, expected, expected, ["doc_id", "label"])


LABEL_PRF = f"""{_patterns_sql(['DEGREE', 'JOB_TITLE'])},
  {cuts_sql('profiles', 'edu', {'DEGREE': pt.EDUCATION_STRINGS})}, {cuts_sql('profiles', 'tit', {'JOB_TITLE': pt.TITLE_STRINGS})},
  expected AS (SELECT doc_id, label, raw AS text FROM edu
    UNION ALL SELECT doc_id, label, regexp_replace(raw, '^[{SP}]+|[{SP}]+$', '', 'g') FROM tit),
  {_prf_sql('lower(text)', 0, 1, 'pattern_entities', 'expected', 'expected', 'doc_id, label')}"""
QUERIES["prf_by_label"] = lambda spark, d: rounded(prf_by_label_rows(spark, d), "precision", "recall", "f1")
SQL["prf_by_label"] = f"WITH {LABEL_PRF} SELECT doc_id, label, {PRF_COLUMNS}, tp, fp, fn FROM prf"
QUERIES["prf_macro"] = lambda spark, d: rounded(me.macro(prf_by_label_rows(spark, d)), "precision", "recall", "f1")
SQL["prf_macro"] = f"""WITH {LABEL_PRF}, m AS (SELECT label, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM prf GROUP BY label)
SELECT label, {PRF_COLUMNS} FROM m UNION ALL SELECT 'OVERALL', NULL, NULL, round(avg(f1), {DIGITS}) FROM m"""


# Samples ----------------------------------------------------------------------------

QUERIES["stratified_sample"] = lambda spark, d: sm.stratified_sample(
    documents(spark, d), 10).select("doc_id", "category")
SQL["stratified_sample"] = """SELECT doc_id, source AS category FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('42-' || doc_id), doc_id) <= 10"""
QUERIES["simple_sample"] = lambda spark, d: sm.simple_sample(
    table(spark, d, "documents").select("doc_id", "lang"), 50)
SQL["simple_sample"] = "SELECT doc_id, lang FROM documents ORDER BY md5('42-' || doc_id), doc_id LIMIT 50"


def corpus_sample(spark, d):
    docs = documents(spark, d)
    return sm.stratified_sample(docs, sm.per_category(docs, 500)).select("doc_id", "category")


QUERIES["corpus_sample"] = corpus_sample
SQL["corpus_sample"] = """SELECT doc_id, source AS category FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('42-' || doc_id), doc_id)
  <= (SELECT greatest(1, 500 // count(DISTINCT source)) FROM documents)"""


# Corpus evaluation ------------------------------------------------------------------

def last_job(spark, d):
    """The default for categories without a job: the last one."""
    j = jobs(spark, d)
    return j.filter(F.col("job_id") == j.select(F.max("job_id")).scalar())


def category_job_lookup(spark, d):
    docs = profiles(spark, d).select("doc_id", "category")
    out = cp.job_of_category(docs, job_templates(spark, d), default_job=last_job(spark, d))
    return out.select("doc_id", "category", "job_id", F.md5("job_text").alias("job_text_md5"))


QUERIES["category_job_lookup"] = category_job_lookup
SQL["category_job_lookup"] = f"""WITH {SQL_PROFILES}, {SQL_TEMPLATES}, {PAIRS_SQL}
SELECT doc_id, category, job_id, md5(j.text) AS job_text_md5 FROM pairs JOIN profiles USING (doc_id) JOIN jobs j USING (job_id)"""


def scored_corpus(spark, d):
    return an.scored_corpus(profiles(spark, d), job_templates(spark, d), last_job(spark, d), taxonomy(spark), STOP_WORDS)


def scored_rows(spark, d):
    out = scored_corpus(spark, d).withColumn("terms", F.array_join("terms", "|"))
    return rounded(out, "skill_f1", "semantic_score", "overall_score")


SCORED = f"""{HITS}, {PAIRS_SQL}, {PAIR_LISTS_SQL}, {SQL_STOP}, {DOC_GRAMS}, {JOB_GRAMS}, {pairs_sql('dg', 'pairs', 'capped')},
  scored AS (SELECT doc_id, category, job_id, true AS success, CAST(len(matched) + len(extra) AS INTEGER) AS skills_extracted,
      CAST(len(matched) AS INTEGER) AS skills_matched, CAST(len(missing) AS INTEGER) AS skills_missing,
      coalesce(f1, 0) AS skill_f1, tfidf AS semantic_score,
      tfidf * CAST(0.3 AS DOUBLE) + coalesce(f1, 0) * 100 * CAST(0.7 AS DOUBLE) AS score,
      list_sort(list_concat(matched, extra)) AS terms
    FROM lists JOIN capped USING (doc_id, job_id) JOIN profiles USING (doc_id) LEFT JOIN overlap USING (doc_id, job_id)),
  levels AS (SELECT *, {FIT_SQL} AS fit_level FROM scored)"""
QUERIES["scored_corpus"] = scored_rows
SQL["scored_corpus"] = f"""WITH {SCORED}
SELECT doc_id, category, job_id, success, skills_extracted, skills_matched, skills_missing, round(skill_f1, {DIGITS}) AS skill_f1,
  round(semantic_score, {DIGITS}) AS semantic_score, round(score, {DIGITS}) AS overall_score, fit_level,
  array_to_string(terms, '|') AS terms, CAST(NULL AS VARCHAR) AS error FROM levels"""

MEANS = ["skills_extracted", "skills_matched", "skill_f1", "semantic_score", "overall_score"]
LEVEL_COUNTS = ", ".join(f"count(*) FILTER (WHERE fit_level = '{x}') AS {x.lower()}" for x in cp.LEVELS)
QUERIES["eval_overall"] = lambda spark, d: rounded(cp.overall(scored_corpus(spark, d)), *[f"avg_{m}" for m in MEANS])
SQL["eval_overall"] = f"""WITH {SCORED} SELECT count(*) AS total_samples, count(*) FILTER (WHERE success) AS successful_samples,
  100.0 * avg(CAST(success AS INTEGER)) AS success_rate,
  """ + ", ".join(f"round(avg({m if m != 'overall_score' else 'score'}), {DIGITS}) AS avg_{m}" for m in MEANS) \
    + f", {LEVEL_COUNTS} FROM levels"
QUERIES["eval_by_category"] = lambda spark, d: rounded(
    cp.by_category(cut_lineage(scored_corpus(spark, d), "scored-corpus")).withColumn("top_terms", F.array_join("top_terms", "|")),
    "avg_skills_extracted", "avg_overall_score", "avg_skill_f1")
SQL["eval_by_category"] = f"""WITH {SCORED},
  counted_terms AS (SELECT category, term, count(*) AS n FROM (SELECT category, unnest(terms) AS term FROM levels) GROUP BY category, term
    QUALIFY row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, term) <= 10),
  top AS (SELECT category, string_agg(term, '|' ORDER BY n DESC, term) AS top_terms FROM counted_terms GROUP BY category)
SELECT category, count(*) AS sample_count,
  round(avg(skills_extracted), {DIGITS}) AS avg_skills_extracted, round(avg(score), {DIGITS}) AS avg_overall_score,
  round(avg(skill_f1), {DIGITS}) AS avg_skill_f1, {LEVEL_COUNTS}, coalesce(any_value(top_terms), '') AS top_terms
FROM levels LEFT JOIN top USING (category) GROUP BY category"""
QUERIES["fit_distribution"] = lambda spark, d: rounded(cp.fit_distribution(scored_corpus(spark, d)), "share")
SQL["fit_distribution"] = f"""WITH {SCORED} SELECT fit_level, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), {DIGITS}) AS share
FROM levels GROUP BY fit_level"""


def categorised_sets(spark, d):
    """Terms per document with its category; documents without terms have an empty list."""
    docs = profiles(spark, d).select("doc_id", "category")
    return _with_sets(docs, doc_sets(spark, d))


def _with_sets(docs, sets):
    return docs.join(sets, "doc_id", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))


def repaired(spark, d):
    """Repaired texts that are long enough, as a corpus is evaluated."""
    text = F.col("text")
    docs = profiles(spark, d).select("doc_id", "category", tx.repair_artefacts(text).alias("text"))
    return docs.filter(tx.long_enough(text))


def repaired_sets(spark, d):
    docs = repaired(spark, d)
    return _with_sets(docs.select("doc_id", "category"), mt.term_sets(docs, taxonomy(spark)))


CORPUS = f"{SQL_TERMS}, {SQL_PROFILES}, {hits_sql('profiles', 'doc_id', 'hits')}"
KEPT = f"kept AS MATERIALIZED (SELECT * FROM (SELECT doc_id, category, {repair_sql('text')} AS text FROM profiles) WHERE length(text) >= 100)"
REPAIRED = f"{SQL_TERMS}, {SQL_PROFILES}, {KEPT}, {hits_sql('kept', 'doc_id', 'hits')}"
QUERIES["top_terms_by_category"] = lambda spark, d: cp.top_terms_by_category(categorised_sets(spark, d))
SQL["top_terms_by_category"] = f"""WITH {CORPUS}, c AS (SELECT p.category, term, count(*) AS n FROM hits JOIN profiles p USING (doc_id) GROUP BY ALL)
SELECT category, term, n, CAST(row_number() OVER (PARTITION BY category ORDER BY n DESC, term) AS INTEGER) AS rank FROM c QUALIFY rank <= 10"""
QUERIES["top_terms"] = lambda spark, d: cp.top_terms(repaired_sets(spark, d), taxonomy(spark))
SQL["top_terms"] = f"""WITH {REPAIRED} SELECT term, count(*) AS n, any_value(category) AS category FROM hits GROUP BY term ORDER BY n DESC, term LIMIT 20"""
QUERIES["expected_recall"] = lambda spark, d: rounded(
    cp.expected_recall(repaired_sets(spark, d), expected_terms(spark)), "avg_recall")
SQL["expected_recall"] = f"""WITH {REPAIRED}, {SQL_EXPECTED},
  sizes AS (SELECT category, count(*) AS len FROM expected GROUP BY category),
  found AS (SELECT doc_id, count(*) AS n FROM hits h JOIN kept p USING (doc_id) JOIN (SELECT DISTINCT category, lower(term) AS term FROM expected) e
    ON e.category = p.category AND e.term = h.term GROUP BY doc_id),
  r AS (SELECT category, coalesce(n, 0) / len AS recall FROM kept JOIN sizes USING (category) LEFT JOIN found USING (doc_id))
SELECT category, count(*) AS n_docs, round(avg(recall), {DIGITS}) AS avg_recall FROM r GROUP BY category
UNION ALL SELECT 'ALL', count(*), round(avg(recall), {DIGITS}) FROM r"""
QUERIES["terms_per_document"] = lambda spark, d: rounded(cp.terms_per_document(repaired_sets(spark, d)), "avg_terms")
SQL["terms_per_document"] = f"""WITH {REPAIRED}, n AS (SELECT p.doc_id, p.category, count(term) AS n FROM kept p LEFT JOIN hits USING (doc_id) GROUP BY ALL)
SELECT category, count(*) AS n_docs, round(avg(n), {DIGITS}) AS avg_terms FROM n GROUP BY category
UNION ALL SELECT 'ALL', count(*), round(avg(n), {DIGITS}) FROM n"""

KINDS = ["organizations", "locations", "dates", "education", "job_titles"]


def entity_count_stats(spark, d):
    """Entities per document over the repaired texts that are long enough."""
    text = F.col("text")
    docs = profiles(spark, d).select("doc_id", tx.repair_artefacts(text).alias("text")).filter(tx.long_enough(text))
    lists = sp.plain_lists(spans(spark, d), taxonomy(spark))
    per_doc = lists.groupBy("doc_id").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS[:3]])
    counts = docs.select("doc_id", F.size(en.education_strings(text)).cast("long").alias("education"),
                         F.size(en.title_strings(text)).cast("long").alias("job_titles"))
    return rounded(cp.count_stats(counts.join(per_doc, "doc_id", "left").fillna(0), KINDS), "avg_count")


QUERIES["entity_count_stats"] = entity_count_stats
SQL["entity_count_stats"] = f"""WITH {SQL_TERMS}, {SQL_PROFILES}, {SQL_SPANS}, {PLAIN_SQL},
  kept AS (SELECT doc_id, text FROM (SELECT doc_id, {repair_sql('text')} AS text FROM profiles) WHERE length(text) >= 100),
  {cuts_sql('kept', 'edu', {'education': pt.EDUCATION_STRINGS})}, {cuts_sql('kept', 'tit', {'job_titles': pt.TITLE_STRINGS})},
  rows_ AS (SELECT doc_id, kind, count(*) AS n FROM plain GROUP BY ALL
    UNION ALL SELECT doc_id, 'education', count(DISTINCT raw) FROM edu GROUP BY doc_id
    UNION ALL SELECT doc_id, 'job_titles', count(DISTINCT trim(raw)) FROM tit GROUP BY doc_id),
  grid AS (SELECT doc_id, kind FROM kept, (SELECT unnest({_sql_list(KINDS)}) AS kind)),
  filled AS (SELECT kind, coalesce(n, 0) AS n FROM grid LEFT JOIN rows_ USING (doc_id, kind))
SELECT kind, round(avg(n), {DIGITS}) AS avg_count, max(n) AS max_count, min(n) AS min_count FROM filled GROUP BY kind"""


def baseline_comparison(spark, d):
    docs = profiles(spark, d)
    paired = cp.job_of_category(docs, job_templates(spark, d), default_job=last_job(spark, d))
    words = paired.select("doc_id", cp.word_recall(F.col("text"), F.col("job_text")).alias("baseline"))
    job_sets = mt.term_sets(jobs(spark, d), taxonomy(spark), "job_id")
    ours = mt.overlap_lists(category_pairs(spark, d), doc_sets(spark, d), job_sets).select("doc_id", "recall")
    both = words.join(ours, "doc_id").agg(
        F.avg("recall").alias("our_avg_recall"), F.avg("baseline").alias("baseline_avg_recall"))
    both = both.withColumn("improvement", 100 * (F.col("our_avg_recall") - F.col("baseline_avg_recall")))
    return rounded(both, "our_avg_recall", "baseline_avg_recall", "improvement")


QUERIES["baseline_comparison"] = baseline_comparison
SQL["baseline_comparison"] = f"""WITH {HITS}, {PAIRS_SQL},
  jw AS (SELECT DISTINCT job_id, unnest(regexp_extract_all(lower(text), '[^{SP}]+')) AS w FROM jobs),
  dw AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[^{SP}]+')) AS w FROM profiles),
  jwn AS (SELECT job_id, count(*) AS n FROM jw GROUP BY job_id),
  held AS (SELECT doc_id, count(*) AS m FROM pairs JOIN jw USING (job_id) JOIN dw USING (doc_id, w) GROUP BY doc_id),
  r AS (SELECT coalesce(o.recall, 0) AS ours, coalesce(held.m, 0) / n AS base FROM pairs JOIN jwn USING (job_id) LEFT JOIN held USING (doc_id)
    LEFT JOIN overlap o USING (doc_id, job_id))
SELECT round(avg(ours), {DIGITS}) AS our_avg_recall, round(avg(base), {DIGITS}) AS baseline_avg_recall,
  round(100 * (avg(ours) - avg(base)), {DIGITS}) AS improvement FROM r"""

QUERIES["best_match_accuracy"] = lambda spark, d: rounded(
    me.accuracy(best_match(spark, d), category_pairs(spark, d)), "accuracy")
SQL["best_match_accuracy"] = f"""WITH {SCORES}, {BEST_SQL}, templates AS (SELECT 'src' || (job_id * 2) AS category, job_id FROM jobs), {PAIRS_SQL},
  r AS (SELECT coalesce(p.job_id = b.job_id, false) AS hit FROM pairs p LEFT JOIN best b USING (doc_id))
SELECT count(*) FILTER (WHERE hit) AS correct, count(*) AS total, round(avg(CAST(hit AS INTEGER)), {DIGITS}) AS accuracy FROM r"""


def win_rate(spark, d):
    """Embedding against TF-IDF over the same pairs: a document's vector by its id, a job's by its label."""
    pairs, (_, docs, reps) = category_pairs(spark, d), vectors(spark, d)
    emb = sim.embedding_of_pairs(pairs, docs, reps)
    tfidf = sim.tfidf_of_texts(pairs, profiles(spark, d), jobs(spark, d), STOP_WORDS)
    return rounded(me.win_rate(tfidf.join(emb, ["doc_id", "job_id"]), "embedding", "tfidf"), "win_rate")


QUERIES["win_rate"] = win_rate
SQL["win_rate"] = f"""WITH {SQL_STOP}, {SQL_PROFILES}, {SQL_TEMPLATES}, {DOC_GRAMS}, {JOB_GRAMS}, {PAIRS_SQL}, {pairs_sql('dg', 'pairs', 'plain')},
  reps AS (SELECT label AS job_id, arg_min(embedding, vec_id) AS rv FROM embeddings GROUP BY label),
  emb AS (SELECT doc_id, job_id, {COSINE_SQL.format(a='embedding', b='rv')} AS e
    FROM pairs JOIN embeddings ON vec_id = doc_id JOIN reps USING (job_id)),
  r AS (SELECT e > tfidf AS win FROM plain LEFT JOIN emb USING (doc_id, job_id))
SELECT count(*) FILTER (WHERE win) AS wins, count(win) AS total, count(*) - count(win) AS without, round(avg(CAST(win AS INTEGER)), {DIGITS}) AS win_rate
FROM r"""

QUERIES["category_counts"] = lambda spark, d: cp.category_counts(documents(spark, d))
SQL["category_counts"] = "SELECT source AS category, count(*) AS n FROM documents GROUP BY source ORDER BY category"
QUERIES["category_word_stats"] = lambda spark, d: rounded(cp.category_word_stats(documents(spark, d)), "avg_words")
SQL["category_word_stats"] = f"""SELECT source AS category, count(*) AS n, round(avg({words_sql('text')}), {DIGITS}) AS avg_words,
  min({words_sql('text')}) AS min_words, max({words_sql('text')}) AS max_words FROM documents GROUP BY source"""
