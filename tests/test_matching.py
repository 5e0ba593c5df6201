"""Similarity, overlap and scores against direct formulas."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fitmill.operators import matching as mt
from fitmill.operators import similarity as sim

SMALL = "/root/testdata/sf0.001"
STOP = ["the", "of"]
WORDS = "the of alpha beta gamma delta été x a1 data set".split()


def corpus(seed, n, longest):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randint(0, longest))) for _ in range(n)]


DOCS = [*corpus(1, 12, 30), "the of the", "", "alpha, alpha! beta_x"]
JOBS = [*corpus(2, 5, 12), "zeta only", "of the"]


def grams(text):
    tokens = [t for t in re.findall(r"\b\w\w+\b", text.lower()) if t not in STOP]
    return Counter(" ".join(tokens[i:i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1))


def tfidf(a, b, cap=None):
    """Two-text TF-IDF with smoothed idf and L2 norm, written out."""
    a, b = grams(a), grams(b)
    terms = sorted(a.keys() | b.keys(), key=lambda g: (-(a[g] + b[g]), g))[:cap]
    idf = {g: math.log(3 / (1 + (g in a) + (g in b))) + 1 for g in terms}
    dot = sum(a[g] * b[g] * idf[g] ** 2 for g in terms)
    na, nb = (math.sqrt(sum((c[g] * idf[g]) ** 2 for g in terms)) for c in (a, b))
    return 100 * dot / (na * nb) if na and nb else 0.0


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    jobs = spark.createDataFrame(list(enumerate(JOBS)), "job_id long, text string")
    return docs, jobs, sim.gram_counts(docs, STOP), sim.gram_counts(jobs, STOP, "job_id")


def test_grams_bridge_stop_words(spark):
    df = spark.createDataFrame([(1, "Alpha of the beta c d2")], "doc_id long, text string")
    got = {(r.gram, r.tf) for r in sim.gram_counts(df, STOP).collect()}
    assert got == {("alpha", 1), ("beta", 1), ("d2", 1), ("alpha beta", 1), ("beta d2", 1), ("alpha beta d2", 1)}


def test_more_texts_get_more_tasks(spark, tables, monkeypatch):
    # by the size of the texts the adaptive planner made a few tasks, whose grams spilled
    monkeypatch.setattr(sim, "TEXTS_A_TASK", 0.5)
    plan = sim.gram_counts(tables[0], STOP)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[doc_id#\d+L\], {max(2 * len(DOCS), 8)}\b", plan)


def test_all_pairs(tables):
    got = {(r.doc_id, r.job_id): r.tfidf for r in sim.tfidf_all_pairs(tables[2], tables[3]).collect()}
    for i, a in enumerate(DOCS):
        for j, b in enumerate(JOBS):
            assert got.get((i, j), 0.0) == pytest.approx(tfidf(a, b), abs=1e-9)


@pytest.mark.parametrize("cap", [None, 500, 7, 1])
def test_given_pairs(spark, tables, cap):
    docs, jobs, dg, jg = tables
    pairs = spark.createDataFrame([(i, i % len(JOBS)) for i in range(len(DOCS))], "doc_id long, job_id long")
    rows = sim.tfidf_of_pairs(pairs, dg, jg, cap).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        assert r.tfidf == pytest.approx(tfidf(DOCS[r.doc_id], JOBS[r.job_id], cap), abs=1e-9)


@pytest.mark.parametrize("cap", [None, 500, 7, 1])
def test_given_pairs_of_texts(spark, cap):
    odd = [*DOCS, "", "of", "alpha", "alpha beta", "alpha alpha alpha alpha", None]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    jobs = spark.createDataFrame(list(enumerate(JOBS)), "job_id long, text string")
    pairs = [(i, j) for i in range(len(odd)) for j in (i % len(JOBS), 0)] + [(10**6, 0), (0, 10**6)]
    rows = sim.tfidf_of_texts(spark.createDataFrame(pairs, "doc_id long, job_id long"), docs, jobs, STOP, cap).collect()
    assert sorted((r.doc_id, r.job_id) for r in rows) == sorted(pairs)
    for r in rows:
        a, b = dict(enumerate(odd)).get(r.doc_id) or "", dict(enumerate(JOBS)).get(r.job_id, "")
        assert r.tfidf == pytest.approx(tfidf(a, b, cap), abs=1e-9)


def test_section_similarity(spark, tables):
    sections = spark.createDataFrame([(0, "skills", "alpha beta"), (0, "other", "  "), (1, "skills", "zeta")],
                                     "doc_id long, section string, text string")
    pairs = spark.createDataFrame([(0, 0), (1, 5)], "doc_id long, job_id long")
    rows = sim.section_similarity(sections, pairs, tables[3], STOP, 500).collect()
    assert {(r.doc_id, r.section, round(r.score, 9)) for r in rows} == {
        (0, "skills", round(tfidf("alpha beta", JOBS[0]), 9)), (1, "skills", round(tfidf("zeta", JOBS[5]), 9))}
    emb = spark.createDataFrame([(1, 5, "skills", 42.0)], "doc_id long, job_id long, section string, embedding double")
    rows = sim.section_similarity(sections, pairs, tables[3], STOP, None, emb).collect()
    assert {r.doc_id: r.score for r in rows}[1] == 42.0


def test_vector_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 3.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])],
                               "a array<float>, b array<float>")
    got = [r[0] for r in df.select(sim.vector_cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(100) and got[1:] == [0.0, None, None]


SETS_D = [(1, ["a", "b", "c"]), (2, ["x"]), (3, [])]
SETS_J = [(10, ["a", "b", "z", "y"]), (11, ["c"]), (12, [])]


@pytest.fixture(scope="module")
def sets(spark):
    return (spark.createDataFrame(SETS_D, "doc_id long, terms array<string>"),
            spark.createDataFrame(SETS_J, "job_id long, terms array<string>"))


def f1(a, b):
    m = len(set(a) & set(b))
    p, r = (m / len(a) if a else 0), (m / len(b) if b else 0)
    return 2 * p * r / (p + r) if p + r else 0


def test_overlap(sets):
    got = {(r.doc_id, r.job_id): r.f1 for r in mt.overlap(*sets).collect()}
    assert got == {(d, j): pytest.approx(f1(a, b)) for d, a in SETS_D for j, b in SETS_J if f1(a, b)}


def test_overlap_lists(spark, sets):
    pairs = spark.createDataFrame([(d, j) for d, _ in SETS_D for j, _ in SETS_J] + [(9, 10)], "doc_id long, job_id long")
    got = {(r.doc_id, r.job_id): r for r in mt.overlap_lists(pairs, *sets).collect()}
    assert (got[1, 10].matched, got[1, 10].missing, got[1, 10].extra) == (["a", "b"], ["y", "z"], ["c"])
    assert got[3, 12].f1 == 0 and got[9, 10].missing == ["a", "b", "y", "z"] and got[9, 10].precision == 0


def test_scores_best_and_grid(spark, sets):
    docs, jobs = sets
    tf = spark.createDataFrame([(1, 10, 50.0), (2, 11, 10.0), (1, 11, 0.0)], "doc_id long, job_id long, tfidf double")
    emb = spark.createDataFrame([(1, 10, 80.0)], "doc_id long, job_id long, embedding double")
    got = {(r.doc_id, r.job_id): r for r in mt.score_pairs(mt.overlap(docs, jobs), tf, emb).collect()}
    assert got[1, 10].score == pytest.approx(80 * 0.3 + f1(*[s[0][1] for s in (SETS_D, SETS_J)]) * 70)
    assert got[2, 11].score == pytest.approx(3.0) and got[2, 11].fit_level == "Weak" and got[1, 10].fit_level == "Moderate"
    scores = mt.score_pairs(mt.overlap(docs, jobs), tf)
    grid = mt.full_grid(scores, docs, [10, 11, 12])
    assert grid.count() == 9 and grid.filter("score = 0").count() == 6
    with pytest.raises(ValueError):
        mt.full_grid(scores, docs, list(range(mt.MOST_JOBS + 1)))
    wide = {r.doc_id: r.asDict() for r in mt.pivot(grid, [10, 11, 12]).collect()}
    assert wide[3] == {"doc_id": 3, "10": 0.0, "11": 0.0, "12": 0.0}


def test_grid_keeps_scores_below_zero(spark):
    scores = spark.createDataFrame([(1, 10, -4.0), (1, 12, 3.0), (1, 13, 9.0)], "doc_id long, job_id long, score double")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    grid = sorted(tuple(r) for r in mt.full_grid(scores, docs, [10, 11, 12]).collect())
    assert grid == [(1, 10, -4.0), (1, 11, 0.0), (1, 12, 3.0), (2, 10, 0.0), (2, 11, 0.0), (2, 12, 0.0)]
    assert mt.full_grid(scores, docs, []).collect() == []


def test_best_job_takes_lowest_id_on_ties(spark):
    df = spark.createDataFrame([(1, 7, 5.0), (1, 3, 5.0), (1, 1, 4.0)], "doc_id long, job_id long, score double")
    assert mt.best_job(df).first().job_id == 3
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    jobs = spark.createDataFrame([(4,), (9,)], "job_id long")
    assert {tuple(r) for r in mt.best_of_all(df, docs, jobs).collect()} == {(1, 3, 5.0), (2, 4, 0.0)}
    top = mt.top_jobs(df, 2).orderBy("rank").collect()
    assert [(r.job_id, r["rank"]) for r in top] == [(3, 1), (7, 2)]


def test_fit_levels(spark):
    df = spark.createDataFrame([(70.0,), (69.9,), (40.0,), (39.9,)], "s double")
    assert [r[0] for r in df.select(mt.fit_level(F.col("s"))).collect()] == ["Strong", "Moderate", "Moderate", "Weak"]


def test_matrix_of_more_jobs_than_a_block(spark, monkeypatch):
    from workload import matching
    want = sorted(tuple(r) for r in matching.match_matrix(spark, SMALL).collect())
    monkeypatch.setattr(mt, "MOST_JOBS", 7)
    assert sorted(tuple(r) for r in matching.match_matrix(spark, SMALL).collect()) == want
