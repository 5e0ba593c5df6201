"""Toxicity and quality: held-out accuracy, which rows are learned from, awkward tables."""

import zlib

import numpy as np
import pytest

from fitmill.llm import labelled, quality, toxicity, workload
from tests.llm.data import edge_docs, edge_rows

LARGE = "/root/testdata/sf0.1"


def auc(truth, score):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    n = truth.sum()
    return (rank[truth == 1].sum() - n * (n - 1) / 2) / (n * (len(truth) - n))


@pytest.mark.parametrize("name, label, modulus, remainder, least", [
    ("op1_toxicity", "toxic", 3, 1, 0.97), ("op7_quality", "quality", 4, 2, 0.99)])
def test_held_out_rows(spark, name, label, modulus, remainder, least):
    out = workload.QUERIES[name](spark, LARGE)
    rows = out.join(spark.read.parquet(f"{LARGE}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    truth, score = np.array([r[label] for r in held]), np.array([r.score for r in held])
    assert auc(truth, score) >= least
    assert np.mean([r.predicted == r[label] for r in held]) >= 0.97


def test_sample_is_bounded_and_without_held_out_rows(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(300)] + [(None, "x"), (5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)] + [(7, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    rows = labelled.sample(docs, labels, "toxic", 3, 1, 1000, 100)
    ids = {int(t.split()[1]) for _, t in rows}
    assert ids == {k for k in range(300) if zlib.crc32(str(k).encode()) % 3 != 1 and k != 7}
    assert len(labelled.sample(docs, labels, "toxic", 3, 1, 20, 100)) == 20
    assert labelled.sample(docs, labels, "toxic", 3, 1, 20, 3) == []


@pytest.mark.parametrize("kind, label", [(toxicity, "toxic"), (quality, "quality")])
def test_awkward_tables(spark, kind, label):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], f"doc_id long, {label} int")
    model = kind.learn(docs, labels)
    out = kind.scored(docs, model).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r.score <= 1 for r in out)
    assert kind.scored(docs.limit(0), model).collect() == []
    for none in (labels.limit(0), labels.where(f"{label} = 0"), labels.where(f"{label} = 1")):
        assert len(kind.scored(docs, kind.learn(docs, none)).collect()) == len(edge_rows())


def test_offending_sentences(spark):
    bad = [(1, f"Nice day number {k}. You are a foolthing. Good bye.") for k in range(30)]
    good = [(0, f"Nice day number {k}. We are here again. Good bye.") for k in range(60)]
    docs = spark.createDataFrame([(1, "Good bye. What a foolthingy! Nice day."), (2, "Nice day."), (3, None)], "doc_id long, text string")
    found = toxicity.offending(docs, toxicity.fit(bad + good)).collect()
    assert [(r.doc_id, r.sentence, r.words) for r in found] == [(1, 1, "what a foolthingy")]


def test_accepted_keeps_columns(spark):
    docs = edge_docs(spark)
    assert quality.accepted(docs, 1.0).count() == len(edge_rows()) and quality.accepted(docs, 0.0).count() == 0
    assert quality.accepted(docs, 1.0).schema == docs.schema
