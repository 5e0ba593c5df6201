"""Mixing sources: targets against plain water-filling, totals, bounds, reruns."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fitmill.llm import mixing, workload
from tests.llm.data import SMALL, edge_docs, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


def check(rows, near):
    sizes, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = plain_targets(dict(sizes))
    assert target == pytest.approx(want)
    assert {r.source: r.source_size for r in rows} == sizes
    for s, t in want.items():
        assert abs(taken[s] - t) <= near * max(t, 1)


def test_given_documents(spark):
    rows = workload.op5_source_mix(spark, SMALL).collect()
    assert len(rows) == 200
    check(rows, 0.05)


def test_awkward_rows_and_reruns(spark):
    docs = edge_docs(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(edge_rows())
    by_text = sorted(len(WORD.findall(t or "")) for _, t, *_ in edge_rows())
    assert sorted(r.size for r in rows) == by_text
    check(rows, 0.2)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(rows, key=repr) == sorted(again, key=repr)


def test_sources_that_stop_at_three_times_their_size(spark):
    rows = [(k, "w " * (1 if k == 0 else 50), "aaa"[: k % 3 + 1] if k else "tiny") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    check(out, 0.3)
    assert next(r for r in out if r.source == "tiny").taken == 3


def test_empty_table_and_no_words(spark):
    docs = edge_docs(spark)
    assert mixing.mix(docs.limit(0)).collect() == []
    assert [r.taken for r in mixing.mix(docs.where("doc_id = 4")).collect()] == [0, 0]


def test_mixed_repeats_rows_and_keeps_columns(spark):
    docs = edge_docs(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    copies = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert out.count() == copies
