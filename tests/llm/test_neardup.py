"""Near duplicates against all pairs, and consistent sampling against the similarity it stands for."""

import numpy as np

from fitmill.llm import neardup as nd
from tests.llm.data import SMALL, edge_docs, edge_rows, prose


def brute(spark, docs):
    """Smallest (doc_id, key) of each row's component, from all pairs."""
    idf, _ = nd.frequencies(docs)
    rows = docs.selectExpr("doc_id", "text", "xxhash64(text) AS k").collect()
    name = lambda r: (r.doc_id is not None, r.doc_id or 0, r.k is not None, r.k or 0)
    texts = {name(r): r for r in rows}
    sets = {k: nd._weighted(r.text, idf) for k, r in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(sets[a][0]) and len(sets[b][0]) and nd.similarity(sets[a], sets[b]) >= 0.8:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(((r.doc_id, r.k, texts[find(name(r))].doc_id, texts[find(name(r))].k) for r in rows), key=repr)


def got(docs):
    return sorted((tuple(r)[:4] for r in nd.classes(docs).collect()), key=repr)


def test_awkward_rows(spark):
    docs = edge_docs(spark)
    out = got(docs)
    assert out == brute(spark, docs) and len(out) == len(edge_rows())
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({o[2:] for o in out})
    assert nd.classes(docs.limit(0)).collect() == [] and nd.deduplicated(docs.limit(0)).collect() == []


def test_a_hot_group_and_pairs_in_it(spark):
    base = prose(1, 120).split()
    rows = []
    for k in range(120):
        words = list(base)
        words[k] = f"edit{k}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, prose(200 + k // 2, 60) + (" end" if k % 2 else "")) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = nd.classes(docs).collect()
    assert {r.class_id for r in out if r.doc_id < 1000} == {0}
    assert all(r.class_id == r.doc_id - r.doc_id % 2 and r.n_class == 2 for r in out if r.doc_id >= 1000)


def test_a_star_of_edits_that_are_unlike_each_other(spark):
    base, rows = prose(1, 120).split(), [(0, prose(1, 120))]
    for k in range(1, 301):
        words = list(base)
        words[5 + k % 50], words[60 + k // 9] = f"edit{k}", f"other{k}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs) == brute(spark, docs)
    assert {(r.class_id, r.n_class) for r in nd.classes(docs).collect()} == {(0, 301)}


def mixed_rows():
    """Pairs of near copies that all share 150 words; without the pairs' own words they are alike at under 0.8."""
    rows = []
    for k in range(200):
        own, other = prose(1000 + k, 40).split(), prose(1000 + k, 40).split()
        for at in (8, 20, 32):
            other[at] = f"edit{k}"
        rows += [(2 * k, " ".join([prose(1, 150), *own])), (2 * k + 1, " ".join([prose(1, 150), *other]))]
    return rows


def test_pairs_in_large_mixed_buckets(spark):
    docs = spark.createDataFrame(mixed_rows(), "doc_id long, text string")
    out = got(docs)
    assert out == brute(spark, docs)
    assert all(class_id == doc_id - doc_id % 2 for doc_id, _, class_id, _ in out)


def cloud_rows(n):
    """Texts that each change three words of one that isn't there, each unlike nearly all others; some have a near copy."""
    base, rows, draw = prose(7, 150).split(), [], np.random.default_rng(3)
    for k in range(n):
        words = list(base)
        for at in draw.choice(150, 3, replace=False):
            words[at] = f"edit{k}x{at}"
        rows.append((2 * k, " ".join(words)))
        if k % 20 == 0:
            rows.append((2 * k + 1, " ".join([*words, "end"])))
    return rows


def test_a_cloud_of_unlike_edits_costs_no_pair_of_each_two(spark, monkeypatch):
    verified, counts = nd._verified, []

    def counted(pairs, *more):
        counts.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(nd, "_verified", counted)
    rows = cloud_rows(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = got(docs)
    assert out == brute(spark, docs)
    assert len({r[2] for r in out}) > 200  # hardly any two are alike
    assert len(counts) > 1 and sum(counts[1:]) < 5 * len(rows)  # the pairs that settle large buckets


def test_sketches_differ_no_more_than_texts():
    draw = np.random.default_rng(5)
    for n in (1, 40, 400, 5000):
        h = np.unique(draw.integers(0, 2**63, 2 * n).astype(np.uint64))
        a, b = h[:n], h[n // 8:n + n // 8]
        apart = np.bitwise_count((nd.sketch(a) ^ nd.sketch(b)).view(np.uint64)).sum()
        assert apart <= len(np.setxor1d(a, b)) and not (nd.sketch(a) ^ nd.sketch(a[::-1])).any()


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got(docs) == brute(spark, docs)


def test_samples_agree_as_often_as_documents_are_alike():
    draw, agree, alike = np.random.default_rng(1), 0, []
    for _ in range(60):
        h = draw.integers(0, 2**63, 300).astype(np.uint64)
        h.sort()
        w = draw.gamma(2, 1, 300)
        w2 = np.where(draw.random(300) < 0.3, w * draw.uniform(0.3, 2, 300), w)
        a, b = (h[:280], w[:280]), (h[20:], w2[20:])
        alike.append(nd.similarity(a, b))
        agree += int((nd.samples(*a) == nd.samples(*b)).sum())
    assert abs(agree / (60 * nd.BANDS * nd.ROWS) - np.mean(alike)) < 0.04


def test_components(spark):
    chain = [(bytes([k]), bytes([k + 1])) for k in range(40)] + [(bytes([90]), bytes([95])), (bytes([80]), bytes([95]))]
    out = nd.components(spark.createDataFrame(chain, "a binary, b binary")).collect()
    assert {bytes(r.node)[0]: bytes(r.root)[0] for r in out} == {k: 0 for k in range(41)} | {80: 80, 90: 80, 95: 80}
