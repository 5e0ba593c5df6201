"""Both exact span deduplications against a dictionary of windows."""

import hashlib
import random

import numpy as np
import pytest

from fitmill.llm import repeats, substring_dedup, suffix_dedup
from tests.llm.data import SMALL, edge_docs, edge_rows, prose, seen_earlier


def ordered(spark, docs):
    rows = docs.selectExpr("doc_id", "text", "xxhash64(text) AS k").collect()
    key = {}
    for r in rows:
        key[r.doc_id is not None, r.doc_id or 0, r.k is not None, r.k or 0] = (r.doc_id, r.text or "")
    return [(k, v) for k, v in sorted(key.items())], rows


def check_bytes(spark, docs):
    distinct, rows = ordered(spark, docs)
    want = {}
    for (_, (doc_id, text)), mask in zip(distinct, seen_earlier([(k, v[1].encode()) for k, v in distinct], 100)):
        data, mask = np.frombuffer(text.encode(), np.uint8), np.array(mask, bool)
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        want[doc_id, text] = (doc_id, len(data), int(mask.sum()), spans, hashlib.sha256(data[~mask].tobytes()).hexdigest())
    got = sorted((tuple(r) for r in suffix_dedup.deduplicated(docs).collect()), key=repr)
    assert got == sorted((want[r.doc_id, r.text or ""] for r in rows), key=repr)


def check_words(spark, docs):
    distinct, rows = ordered(spark, docs)
    want = {}
    for (_, (doc_id, text)), mask in zip(distinct, seen_earlier([(k, v[1].encode().split()) for k, v in distinct], 20)):
        words = text.encode().split()
        kept = b" ".join(w for w, m in zip(words, mask) if not m)
        want[doc_id, text] = (doc_id, len(words), sum(mask), hashlib.sha256(kept).hexdigest())
    got = sorted((tuple(r) for r in substring_dedup.deduplicated(docs).collect()), key=repr)
    assert got == sorted((want[r.doc_id, r.text or ""] for r in rows), key=repr)


@pytest.mark.parametrize("check", [check_bytes, check_words])
def test_awkward_rows(spark, check):
    check(spark, edge_docs(spark))


@pytest.mark.parametrize("check", [check_bytes, check_words])
def test_hashes_parted_over_buckets(spark, check, monkeypatch):
    monkeypatch.setattr(repeats, "OF_ONE_HASH", 2)
    monkeypatch.setattr(repeats, "BUCKET", 5)
    draw, line = random.Random(4), prose(9, 22)
    rows = [(k, f"{prose(50 + k, draw.randrange(3, 40))} {line} {prose(90 + k % 7, 30)}") for k in range(60)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("check", [check_bytes, check_words])
def test_given_documents(spark, check):
    check(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_empty_table(spark):
    docs = edge_docs(spark).limit(0)
    assert suffix_dedup.deduplicated(docs).collect() == [] and substring_dedup.deduplicated(docs).collect() == []


def test_texts_left_over(spark):
    text = prose(1, 40)
    docs = spark.createDataFrame([(1, text), (2, "start " + text + " end")], "doc_id long, text string")
    words = {r.doc_id: r.kept for r in substring_dedup.deduplicated(docs, with_text=True).collect()}
    assert words == {1: text, 2: "start end"}
    left = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.deduplicated(docs, with_text=True).collect()}
    assert left == {1: text, 2: "start  end"}


def test_stretches_cover_all_windows():
    draw = random.Random(2)
    for t in range(150):
        x = bytes(draw.choices(b"abc" if t % 3 else b"ab", k=draw.randrange(90, 700)))
        x += b"xyz " * 200 if t % 7 == 0 else b"a" * 500 if t % 5 == 0 else b""
        _, _, _, place, n, twice = repeats.stretches(*suffix_dedup.symbols([x]), 100, 20)
        assert n.sum() == max(0, len(x) - 99) and (np.cumsum(n) - n == place).all()
        for p, m, flag in zip(place, n, twice):
            windows = [x[k:k + 100] for k in range(p, p + m)]
            assert flag or len(set(windows)) == len(windows)


def test_stretches_of_documents_in_a_row():
    draw = random.Random(8)
    texts = [b"".join(draw.choice([b"ab ", b"c", b"de "]) for _ in range(draw.choice([0, 3, 60, 400]))) for _ in range(60)]
    for kind in (suffix_dedup.KIND, substring_dedup.KIND):
        of, *together = repeats.stretches(*kind.symbols(texts), kind.length, kind.piece)
        for k, text in enumerate(texts):
            alone = repeats.stretches(*kind.symbols([text]), kind.length, kind.piece)[1:]
            assert [c[of == k].tolist() for c in together] == [c.tolist() for c in alone]


def test_sort_within_groups():
    draw = random.Random(9)
    data = bytes(draw.choices(b"ab", k=3000))
    places = np.array(draw.sample(range(2900), 1200))
    groups = np.sort(np.array(draw.choices(range(40), [k * k for k in range(1, 41)], k=1200)))
    out = suffix_dedup.Suffixes(data, 100).sorted(places, groups)
    for g in range(40):
        assert out[groups == g].tolist() == sorted(places[groups == g].tolist(), key=lambda p: (data[p:p + 100], p))


@pytest.mark.parametrize("repeated", [suffix_dedup.repeated_windows, substring_dedup.repeated_windows])
def test_buckets(repeated):
    draw = random.Random(6)
    for t in range(120):
        base = [draw.choice(["aa", "b", "cc"] if t % 2 else list("abcdefghijklmnop")) for _ in range(80)]
        rows = []
        for _ in range(6):
            begin = draw.randrange(20)
            piece = base[begin:begin + draw.randrange(60)] + ["q"] * draw.randrange(130, 160)
            if draw.random() < 0.5:
                piece[draw.randrange(len(piece))] = "zz"
            rows.append(" ".join(piece).encode())
        split = [r.split() if repeated is substring_dedup.repeated_windows else r for r in rows]
        size, seen = (20 if repeated is substring_dedup.repeated_windows else 100), set()
        for x, mask in zip(split, repeated(rows, np.zeros(6, np.int64))):
            want = []
            for k in range(len(x) - size + 1):
                w = repr(x[k:k + size])
                want.append(w in seen)
                seen.add(w)
            assert mask.tolist() == want


def test_hash_collisions_fall_back_to_bytes(monkeypatch):
    monkeypatch.setattr(suffix_dedup.Hashes, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    x, y = b"a" * 60 + b"b" * 60, b"c" * 120
    masks = suffix_dedup.repeated_windows([x, y, x], np.zeros(3, np.int64))
    assert [m.tolist() for m in masks[::2]] == [[False] * 21, [True] * 21] and masks[1].tolist() == [False] + [True] * 20
