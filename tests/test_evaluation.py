"""Feedback, metrics, samples and corpus statistics."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fitmill.operators import corpus as cp
from fitmill.operators import feedback as fb
from fitmill.operators import metrics as me
from fitmill.operators import sampling as sm
from fitmill.plans import analysis as an
from fitmill.rules import wordlists as wl
from tests.samples import taxonomy


def feedback(spark, score, matched, missing, extra, by_category):
    df = spark.createDataFrame(
        [(score, matched, missing, extra, by_category)],
        "score double, matched array<string>, missing array<string>, extra array<string>, cats map<string,array<string>>")
    c = F.col
    return df.select(
        fb.recommendations(c("score"), c("matched"), c("missing"), c("cats")).alias("recs"),
        fb.priority_gap(c("missing"), c("cats")).alias("gap"),
        fb.intro_paragraph(c("matched"), c("cats"), F.lit("Chef"), template="{title}: {terms} / {first} @ {company}").alias("intro"),
        fb.suggestions(c("missing"), c("extra")).alias("tips")).first()


def test_feedback(spark):
    cats = {"databases": ["d1", "d2", "d3", "m2"], "soft": ["m1", "s1"], "big_data": ["b1"]}
    r = feedback(spark, 71.0, ["m1", "m2"], ["b1", "d1", "d2", "d3", "s1"], ["e1", "e2", "e3", "e4"], cats)
    assert r.recs == [wl.FIT_SENTENCES["Strong"], "Emphasize your experience with: m1, m2.",
                      "Priority development area: d1, d2 (databases).", "Focus on developing: b1, d1, d2."]
    assert r.gap.category == "databases" and r.intro == "Chef: m2 / m2 @ your company"
    assert r.tips == ["Keywords to consider adding (if applicable): b1, d1, d2, d3, s1", "Unique skills to highlight: e1, e2, e3"]


def test_feedback_without_terms(spark):
    r = feedback(spark, 0.0, [], [], [], {})
    assert r.recs == [wl.FIT_SENTENCES["Weak"]] and r.gap is None and r.intro == wl.NO_MATCH_INTRO and r.tips == []


@pytest.mark.parametrize("terms,want", [(["a"], "a"), (["a", "b"], "a, and b"), (list("abcdef"), "a, b, c, and d")])
def test_intro_lists(spark, terms, want):
    assert feedback(spark, 1.0, terms, [], [], {}).intro.split(": ")[1].split(" / ")[0] == want


def prf(spark, **options):
    rows = "doc_id long, label string, text string"
    predicted = spark.createDataFrame([(1, "A", "X"), (1, "A", "x"), (1, "A", "q"), (3, "A", "z"), (2, "B", "n")], rows)
    truth = spark.createDataFrame([(1, "A", "x"), (1, "A", "Y"), (2, "A", "w"), (2, "B", "N")], rows)
    cases = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A"), (2, "B")], "doc_id long, label string")
    return me.set_prf(predicted, truth, cases, ["doc_id", "label"], **options)


def test_set_prf(spark):
    got = {(r.doc_id, r.label): tuple(r)[2:] for r in prf(spark).collect()}
    assert got == {(1, "A"): (0.5, 0.5, 0.5, 1, 1, 1), (2, "A"): (0.0, 0.0, 0.0, 0, 0, 1),
                   (3, "A"): (1.0, 1.0, 1.0, None, None, None), (2, "B"): (1.0, 1.0, 1.0, 1, 0, 0)}


def test_set_prf_conventions(spark):
    got = {(r.doc_id, r.label): tuple(r)[2:5]
           for r in prf(spark, case_sensitive=True, zero_division=1.0, empty_truth=0.0).collect()}
    assert got[1, "A"] == (pytest.approx(1 / 3), 0.5, pytest.approx(0.4))
    assert got[2, "A"] == (1.0, 0.0, 0.0) and got[3, "A"] == (0.0, 0.0, 0.0) and got[2, "B"] == (0.0, 0.0, 0.0)


def test_macro(spark):
    got = {r.label: r.f1 for r in me.macro(prf(spark)).collect()}
    assert got == {"A": pytest.approx(0.5), "B": 1.0, "OVERALL": pytest.approx(0.75)}


def test_accuracy_and_win_rate(spark):
    found = spark.createDataFrame([(1, 1), (2, 5)], "doc_id long, job_id long")
    want = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "doc_id long, job_id long")
    assert me.accuracy(found, want).first().correct == 1
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 1.0)], "a double, b double")
    assert me.win_rate(df, "a", "b").first().win_rate == 0.5


def hashed(i):
    return hashlib.md5(f"42-{i}".encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 7, 400, 5000])
def test_stratified_sample_of_a_hot_category(spark, n):
    ids = {"hot": range(0, 3000), "small": range(3000, 3005), None: range(4000, 4020)}
    df = spark.createDataFrame([(i, c) for c, r in ids.items() for i in r], "doc_id long, category string")
    got = {r.doc_id for r in sm.stratified_sample(df, n).collect()}
    assert got == {i for r in ids.values() for i in sorted(r, key=hashed)[:n]}
    assert [r.doc_id for r in sm.simple_sample(df, 3).collect()] == sorted([i for r in ids.values() for i in r], key=hashed)[:3]


def test_rows_per_category(spark):
    df = spark.createDataFrame([(i, f"c{i % 4}") for i in range(40)], "doc_id long, category string")
    assert sm.stratified_sample(df, sm.per_category(df, 9)).count() == 8
    assert sm.stratified_sample(df, sm.per_category(df, 1)).count() == 4


def test_scored_corpus_and_summary(spark):
    docs = spark.createDataFrame([(1, "a", "Python and sql data"), (2, "a", None), (3, "b", ""), (4, None, "c++x node.js")],
                                 "doc_id long, category string, text string")
    templates = spark.createDataFrame([("a", 7, "python data analyst")], "category string, job_id long, text string")
    default = spark.createDataFrame([(0, "node.js")], "job_id long, text string")
    scored = an.scored_corpus(docs, templates, default, taxonomy(spark), ["and"]).cache()
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == 4 and not rows[2].success and rows[2].error and rows[2].overall_score is None
    assert rows[1].job_id == 7 and rows[1].terms == ["data", "python", "sql"] and rows[1].skills_matched == 2
    assert rows[3].job_id == 0 and rows[3].overall_score == 0 and rows[4].skill_f1 > 0
    total = cp.overall(scored).first()
    assert (total.total_samples, total.successful_samples, total.success_rate) == (4, 3, 75.0)
    assert {r.category: r.sample_count for r in cp.by_category(scored).collect()} == {"a": 1, "b": 1, None: 1}
    assert sum(r.share for r in cp.fit_distribution(scored).collect()) == pytest.approx(100)


def test_corpus_statistics(spark):
    sets = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "a", ["x"]), (3, "b", []), (4, "c", ["y"])],
                                 "doc_id long, category string, terms array<string>")
    expected = spark.createDataFrame([("a", "X"), ("a", "y"), ("a", "none"), ("b", "x")], "category string, term string")
    assert {r.category: r.avg_recall for r in cp.expected_recall(sets, expected).collect()} == {
        "a": pytest.approx(0.5), "b": 0.0, "ALL": pytest.approx(1 / 3)}
    assert {r.category: r.avg_terms for r in cp.terms_per_document(sets).collect()} == {"a": 1.5, "b": 0.0, "c": 1.0, "ALL": 1.0}
    top = [(r.category, r.term, r.n) for r in cp.top_terms_by_category(sets, 1).orderBy("category").collect()]
    assert top == [("a", "x", 2), ("c", "y", 1)]
    assert {(r.term, r.n, r.category) for r in cp.top_terms(sets, taxonomy(spark)).collect()} == {("x", 2, "words"), ("y", 2, "other")}


def test_default_job_text(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "doc_id long, category string")
    templates = spark.createDataFrame([("a", 7, "seven")], "category string, job_id long, text string")
    got = {r.doc_id: r.job_text for r in cp.job_of_category(docs, templates, "default").collect()}
    assert got == {1: "seven", 2: "default", 3: "default"}


def test_full_analysis_with_embeddings(spark):
    docs = spark.createDataFrame([(1, "Python data"), (2, "nothing")], "doc_id long, text string")
    jobs = spark.createDataFrame([(5, "python data analyst c++x"), (6, "sql")], "job_id long, text string")
    t = taxonomy(spark)
    pairs = an.best_pairs(docs, jobs, t)
    assert {(r.doc_id, r.job_id) for r in pairs.collect()} == {(1, 5), (2, 5)}
    emb = spark.createDataFrame([(1, 5, 90.0)], "doc_id long, job_id long, embedding double")
    rows = {r.doc_id: r for r in an.full_analysis(pairs, docs, jobs, t, [], emb).collect()}
    assert rows[1].overall_score == pytest.approx(27 + 70 * rows[1].f1) and rows[1].missing == ["c", "c++", "data analyst", "x"]
    assert rows[2].overall_score == 0 and rows[2].intro == wl.NO_MATCH_INTRO and len(rows) == 2
