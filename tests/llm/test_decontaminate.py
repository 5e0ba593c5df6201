"""Decontamination against a dictionary of windows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fitmill.llm import decontaminate as dc
from fitmill.llm import workload
from tests.llm.data import SMALL, edge_docs, edge_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for i, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add("null" if i is None else str(i))
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, found = words(text), set()
        hit = [False] * len(w)
        for size in sizes:
            for k in range(len(w) - size + 1):
                if names := windows.get(tuple(w[k:k + size])):
                    found |= names
                    hit[k:k + size] = [True] * size
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), sum(hit), len(found), digest, any(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, prose(1, 80)[40:300]), (2, "Word"), (3, "a B c"), (4, None), (5, ""), (5, prose(2, 4000)[5000:5200]), (None, "漢字 é"), (2, prose(4, 25)),
         (30, "of it all line one of it all line one of"), (4, "tree1")]


@pytest.mark.parametrize("drop", [(), (2, 3, None, 4)])
def test_awkward_rows(spark, drop):
    items = [x for x in ITEMS if x[0] not in drop]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    got = dc.matches(edge_docs(spark), bench).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([r[:2] for r in edge_rows()], items)


def test_empty_tables(spark):
    docs, bench = edge_docs(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.matches(docs.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in dc.matches(docs, bench.limit(0)).collect())


def test_given_documents(spark):
    read = {t: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(i, "text").collect()]
            for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))}
    got = sorted((tuple(r) for r in workload.op6_decontamination(spark, SMALL).collect()), key=repr)
    assert got == brute(read["documents"], read["benchmark"])


def test_cleaned(spark):
    item, clean = prose(7, 12), prose(8, 30)
    rows = [(1, f"{clean}, {item.upper()}. {clean}"), (2, item), (3, clean), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r for r in dc.cleaned(docs, bench).collect()}
    assert sorted(out) == [1, 3, 4, 5] and out[3].text == clean and out[4].text is None
    assert out[1].text == f"{clean}, {clean}" and out[1].n_chars == len(out[1].text)


def test_shards_give_what_one_automaton_gives(spark, monkeypatch):
    docs, bench = edge_docs(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted((tuple(r) for r in dc.cleaned(docs, bench).collect()), key=repr)
    monkeypatch.setattr(dc, "MOST_WORDS", 40)
    monkeypatch.setattr(dc, "PIECE", 30)
    lists = list(dc.shards(bench))
    assert len(lists) > 3 and all(sum(len(words(t)) for _, t in x) <= 40 for x in lists)
    got = dc.matches(docs, bench).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([r[:2] for r in edge_rows()], ITEMS)
    assert sorted((tuple(r) for r in dc.cleaned(docs, bench).collect()), key=repr) == whole


def test_too_large_a_benchmark(spark, monkeypatch):
    monkeypatch.setattr(dc, "MOST_WORDS", 10)
    with pytest.raises(ValueError):
        dc.collect_items(spark.createDataFrame(ITEMS, "item_id long, text string"))
