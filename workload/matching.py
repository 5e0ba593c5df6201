"""Similarity, overlap and scores of documents against jobs."""

from __future__ import annotations


from pyspark.sql import functions as F

from fitmill.operators import matching as mt
from fitmill.operators import sections as sec
from fitmill.operators import similarity as sim
from fitmill.rules.wordlists import MAX_FEATURES
from fitmill.session import stack
from workload.extraction import PROFILE_HITS
from workload.inputs import (
    SQL_JOBS, SQL_PROFILES, SQL_STOP, SQL_TEMPLATES, STOP_WORDS, hits_sql, job_templates, jobs, profiles, table, taxonomy,
)
from workload.sections import SLICES_SQL
from workload.text import W

QUERIES, SQL = {}, {}
DIGITS = 6


def doc_sets(spark, d):
    return mt.term_sets(profiles(spark, d), taxonomy(spark))


def job_sets(spark, d):
    return mt.term_sets(jobs(spark, d), taxonomy(spark), "job_id")


def doc_grams(spark, d):
    return sim.gram_counts(profiles(spark, d), STOP_WORDS)


def job_grams(spark, d):
    return sim.gram_counts(jobs(spark, d), STOP_WORDS, "job_id")


def category_pairs(spark, d):
    """Each document with the job of its category, the last job where the category has none."""
    templates = job_templates(spark, d).select("category", "job_id")
    last = jobs(spark, d).agg(F.max("job_id")).scalar()
    return (
        profiles(spark, d).select("doc_id", "category").join(templates, "category", "left")
        .select("doc_id", F.coalesce("job_id", last).alias("job_id"))
    )


def grams_sql(texts, key, name):
    return f"""{name}_all AS (SELECT {key}, regexp_extract_all(lower(text), '[{W}]{{2,}}') AS ws FROM {texts}),
  {name}_tok AS (SELECT {key}, list_filter(ws, lambda w: NOT list_contains(sw, w)) AS ws FROM {name}_all, (SELECT list(word) AS sw FROM stops)),
  {name}_pos AS (SELECT {key}, ws, unnest(range(1, len(ws) + 1)) AS i FROM {name}_tok),
  {name}_n AS (SELECT {key}, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM {name}_pos, (VALUES (1), (2), (3)) t(n) WHERE i + n - 1 <= len(ws)),
  {name} AS MATERIALIZED (SELECT {key}, gram, count(*) AS tf FROM {name}_n GROUP BY {key}, gram)"""


DOC_GRAMS = grams_sql("profiles", "doc_id", "dg")
JOB_GRAMS = grams_sql("jobs", "job_id", "jg")
GRAMS = f"{SQL_STOP}, {SQL_PROFILES}, {SQL_JOBS}, {DOC_GRAMS}, {JOB_GRAMS}"
# Weighted sums with the two inverse document frequencies written out
IDF = "(ln(3.0 / 2) + 1)"
TFIDF_SQL = f"""dsum AS (SELECT doc_id, sum(tf * tf) AS sa FROM dg GROUP BY doc_id),
  jsum AS (SELECT job_id, sum(tf * tf) AS sb FROM jg GROUP BY job_id),
  shared AS (SELECT doc_id, job_id, sum(dg.tf * jg.tf) AS ab, sum(dg.tf * dg.tf) AS ssa, sum(jg.tf * jg.tf) AS ssb
    FROM dg JOIN jg USING (gram) GROUP BY doc_id, job_id),
  tfidf AS (SELECT doc_id, job_id, CAST(100.0 * ab / (sqrt({IDF} * {IDF} * (sa - ssa) + ssa) * sqrt({IDF} * {IDF} * (sb - ssb) + ssb)) AS DOUBLE) AS tfidf
    FROM shared JOIN dsum USING (doc_id) JOIN jsum USING (job_id))"""


def tfidf_all(spark, d):
    return sim.tfidf_all_pairs(doc_grams(spark, d), job_grams(spark, d))


QUERIES["tfidf_pair"] = lambda spark, d: tfidf_all(spark, d).select(
    "doc_id", "job_id", F.round("tfidf", DIGITS).alias("tfidf"))
SQL["tfidf_pair"] = f"WITH {GRAMS}, {TFIDF_SQL} SELECT doc_id, job_id, round(tfidf, {DIGITS}) AS tfidf FROM tfidf"

PAIRS_SQL = """pairs AS (SELECT doc_id, coalesce(t.job_id, (SELECT max(job_id) FROM jobs)) AS job_id
    FROM profiles p LEFT JOIN templates t USING (category))"""


def pairs_sql(docs, pairs, name, key="doc_id", most=None):
    """Direct formula over the grams of each pair, or the most frequent of them."""
    kept = f"QUALIFY row_number() OVER (PARTITION BY {key}, job_id ORDER BY a + b DESC, gram) <= {most}" if most else ""
    return f"""{name}_u AS (SELECT {key}, job_id, gram, sum(a) AS a, sum(b) AS b FROM (
      SELECT {key}, job_id, gram, tf AS a, 0 AS b FROM {docs} JOIN {pairs} USING ({key})
      UNION ALL SELECT {key}, job_id, gram, 0, tf FROM jg JOIN {pairs} USING (job_id)) GROUP BY {key}, job_id, gram),
  {name}_k AS (SELECT *, CASE WHEN a > 0 AND b > 0 THEN 1.0 ELSE ln(3.0 / 2) + 1 END AS idf FROM {name}_u {kept}),
  {name}_s AS (SELECT {key}, job_id, sum(a * idf * b * idf) AS dot, sqrt(sum(a * idf * a * idf)) AS na, sqrt(sum(b * idf * b * idf)) AS nb
    FROM {name}_k GROUP BY {key}, job_id),
  {name} AS (SELECT {key}, job_id, CAST(CASE WHEN na > 0 AND nb > 0 THEN 100 * dot / (na * nb) ELSE 0 END AS DOUBLE) AS tfidf
    FROM {pairs} LEFT JOIN {name}_s USING ({key}, job_id))"""


CAPPED = (f"{SQL_STOP}, {SQL_PROFILES}, {SQL_TEMPLATES}, {DOC_GRAMS}, {JOB_GRAMS}, {PAIRS_SQL}, "
          + pairs_sql("dg", "pairs", "capped", most=MAX_FEATURES))


def tfidf_capped(spark, d):
    return sim.tfidf_of_texts(category_pairs(spark, d), profiles(spark, d), jobs(spark, d), STOP_WORDS, MAX_FEATURES)


QUERIES["tfidf_pair_capped"] = lambda spark, d: tfidf_capped(spark, d).select(
    "doc_id", "job_id", F.round("tfidf", DIGITS).alias("tfidf"))
SQL["tfidf_pair_capped"] = f"WITH {CAPPED} SELECT doc_id, job_id, round(tfidf, {DIGITS}) AS tfidf FROM capped"


def vectors(spark, d):
    """Every vector as a document; per label the vector with the lowest id as the job."""
    v = table(spark, d, "embeddings")
    docs = v.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    reps = v.groupBy("label").agg(F.min("vec_id").alias("rep"))
    own = v.select(F.col("vec_id").alias("rep"), F.col("embedding").alias("vector"))
    reps = reps.join(own, "rep").select(F.col("label").cast("long").alias("job_id"), "vector")
    pairs = v.select(F.col("vec_id").alias("doc_id"), F.col("label").cast("long").alias("job_id"))
    return pairs, docs, reps


QUERIES["embedding_cosine"] = lambda spark, d: sim.embedding_of_pairs(*vectors(spark, d)).select(
    "doc_id", "job_id", F.round("embedding", 4).alias("embedding"))
COSINE_SQL = """CAST(100 * list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS DOUBLE) * z[2]))
   / (sqrt(list_sum(list_transform({a}, lambda x: CAST(x AS DOUBLE) * x))) * sqrt(list_sum(list_transform({b}, lambda x: CAST(x AS DOUBLE) * x)))) AS DOUBLE)"""
SQL["embedding_cosine"] = f"""WITH reps AS (SELECT label, arg_min(embedding, vec_id) AS rv FROM embeddings GROUP BY label)
SELECT vec_id AS doc_id, CAST(label AS BIGINT) AS job_id, round({COSINE_SQL.format(a='embedding', b='rv')}, 4) AS embedding
FROM embeddings JOIN reps USING (label)"""


def section_similarity(spark, d):
    slices = sec.long_form(sec.with_slices(profiles(spark, d)), "slices")
    scored = sim.section_similarity(slices, category_pairs(spark, d), job_grams(spark, d), STOP_WORDS)
    return scored.withColumn("score", F.round("score", DIGITS))


QUERIES["section_similarity"] = section_similarity
SQL["section_similarity"] = f"""WITH {SQL_STOP}, {SQL_PROFILES}, {SQL_TEMPLATES}, {PAIRS_SQL}, {JOB_GRAMS}, {SLICES_SQL},
  parts AS (SELECT doc_id || '/' || section AS part, doc_id, section, text FROM slices WHERE trim(text) <> ''),
  {grams_sql('parts', 'part', 'pg')},
  part_pairs AS (SELECT part, job_id FROM parts JOIN pairs USING (doc_id)),
  {pairs_sql('pg', 'part_pairs', 'scored', 'part')}
SELECT doc_id, job_id, section, round(tfidf, {DIGITS}) AS score FROM scored JOIN parts USING (part)"""


# Overlap ----------------------------------------------------------------------------

def overlaps(spark, d):
    return mt.overlap(doc_sets(spark, d), job_sets(spark, d))


def term_overlap(spark, d):
    lists = mt.overlap_lists(overlaps(spark, d).select("doc_id", "job_id"), doc_sets(spark, d), job_sets(spark, d))
    return lists.select("doc_id", "job_id", *[F.array_join(c, "|").alias(c) for c in ("matched", "missing", "extra")],
                        *[F.round(c, DIGITS).alias(c) for c in ("precision", "recall", "f1")])


HITS = f"{PROFILE_HITS}, {SQL_JOBS}, {hits_sql('jobs', 'job_id', 'job_hits')}"
OVERLAP_SQL = """dn AS (SELECT doc_id, count(*) AS nd FROM hits GROUP BY doc_id),
  jn AS (SELECT job_id, count(*) AS nj FROM job_hits GROUP BY job_id),
  counted AS (SELECT doc_id, job_id, count(*) AS m FROM hits JOIN job_hits USING (term) GROUP BY doc_id, job_id),
  overlap AS (SELECT doc_id, job_id, m, m / nd AS precision, m / nj AS recall, 2 * (m / nd) * (m / nj) / (m / nd + m / nj) AS f1
    FROM counted JOIN dn USING (doc_id) JOIN jn USING (job_id))"""
# A - B on sorted lists, joined with bars
LISTS_SQL = """dl AS (SELECT doc_id, list(term ORDER BY term) AS d FROM hits GROUP BY doc_id),
  jl AS (SELECT job_id, list(term ORDER BY term) AS j FROM job_hits GROUP BY job_id)"""
MATCHED = "list_filter(j, lambda x: list_contains(d, x))"
MISSING = "list_filter(j, lambda x: NOT list_contains(d, x))"
EXTRA = "list_filter(d, lambda x: NOT list_contains(j, x))"
QUERIES["term_overlap"] = term_overlap
SQL["term_overlap"] = f"""WITH {HITS}, {OVERLAP_SQL}, {LISTS_SQL}
SELECT doc_id, job_id, array_to_string({MATCHED}, '|') AS matched, array_to_string({MISSING}, '|') AS missing,
  array_to_string({EXTRA}, '|') AS extra, round(precision, {DIGITS}) AS precision, round(recall, {DIGITS}) AS recall, round(f1, {DIGITS}) AS f1
FROM overlap JOIN dl USING (doc_id) JOIN jl USING (job_id)"""


# Scores -----------------------------------------------------------------------------

def scores(spark, d):
    return mt.score_pairs(overlaps(spark, d), tfidf_all(spark, d))


SCORES = f"""{HITS}, {OVERLAP_SQL}, {SQL_STOP}, {DOC_GRAMS}, {JOB_GRAMS}, {TFIDF_SQL},
  scores AS MATERIALIZED (SELECT doc_id, job_id, coalesce(f1, 0) AS f1, coalesce(tfidf, 0) AS tfidf,
      coalesce(tfidf, 0) * CAST(0.3 AS DOUBLE) + coalesce(f1, 0) * 100 * CAST(0.7 AS DOUBLE) AS score FROM overlap FULL JOIN tfidf USING (doc_id, job_id))"""
QUERIES["fused_score"] = lambda spark, d: scores(spark, d).select(
    "doc_id", "job_id", F.round("f1", DIGITS).alias("f1"), F.round("score", DIGITS).alias("score"))
SQL["fused_score"] = f"WITH {SCORES} SELECT doc_id, job_id, round(f1, {DIGITS}) AS f1, round(score, {DIGITS}) AS score FROM scores"

FIT_SQL = "CASE WHEN score >= 70 THEN 'Strong' WHEN score >= 40 THEN 'Moderate' ELSE 'Weak' END"
QUERIES["fit_level"] = lambda spark, d: scores(spark, d).select("doc_id", "job_id", "fit_level")
SQL["fit_level"] = f"WITH {SCORES} SELECT doc_id, job_id, {FIT_SQL} AS fit_level FROM scores"


def match_matrix(spark, d):
    listed = [r.job_id for r in jobs(spark, d).select("job_id").toLocalIterator()]
    found, docs = scores(spark, d), profiles(spark, d)
    blocks = [listed[k:k + mt.MOST_JOBS] for k in range(0, len(listed), mt.MOST_JOBS)] or [[]]
    grid = stack(*[mt.full_grid(found, docs, block) for block in blocks])
    return grid.withColumn("score", F.round("score", DIGITS))


QUERIES["match_matrix"] = match_matrix
SQL["match_matrix"] = f"""WITH {SCORES}
SELECT p.doc_id, j.job_id, round(coalesce(score, 0), {DIGITS}) AS score
FROM profiles p CROSS JOIN jobs j LEFT JOIN scores s ON s.doc_id = p.doc_id AND s.job_id = j.job_id"""


def best_match(spark, d):
    rounded = scores(spark, d).withColumn("score", F.round("score", DIGITS))
    return mt.best_of_all(rounded, profiles(spark, d), jobs(spark, d))


BEST_SQL = f"""found AS (SELECT doc_id, job_id, round(score, {DIGITS}) AS score FROM scores
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, {DIGITS}) DESC, job_id) = 1),
  best AS (SELECT doc_id, coalesce(job_id, (SELECT min(job_id) FROM jobs)) AS job_id, coalesce(score, 0) AS score
    FROM profiles LEFT JOIN found USING (doc_id))"""
QUERIES["best_match"] = best_match
SQL["best_match"] = f"WITH {SCORES}, {BEST_SQL} SELECT doc_id, job_id, score FROM best"
