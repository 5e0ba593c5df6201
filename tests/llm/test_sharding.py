"""Sharding against plain best-fit-decreasing packing, and its law."""

import random
import zlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from fitmill.llm import sharding, workload
from tests.llm.data import SMALL, edge_docs, edge_rows


def plain_pack(sizes, capacity):
    left, out = [], []
    for size in sizes:
        fits = [(room, k) for k, room in enumerate(left) if room >= size]
        if not fits:
            left.append(capacity)
            fits = [(capacity, len(left) - 1)]
        _, k = min(fits)
        left[k] -= size
        out.append(k)
    return out


@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 120))
def test_best_fit_by_the_tree(sizes, capacity):
    sizes.sort(reverse=True)
    assert sharding.pack(sizes, capacity) == plain_pack(sizes, capacity)


@given(st.lists(st.integers(1, 500), max_size=60), st.integers(1, 9))
def test_level_uses_no_more_shards_and_bounds_them(sizes, n):
    sizes.sort(reverse=True)
    shards = sharding.level(sizes, n)
    assert len(shards) == len(sizes) and all(0 <= s < n for s in shards)
    loads = defaultdict(int)
    for size, shard in zip(sizes, shards):
        loads[shard] += size
    assert max(loads.values(), default=0) <= 2 * max(sizes[:1] + [sum(sizes) / n]) + 1


def test_many_small_groups_are_near_equal():
    draw = random.Random(4)
    sizes = sorted([100_000] + [draw.randrange(1, 400) for _ in range(4000)], reverse=True)
    loads = defaultdict(int)
    for size, shard in zip(sizes, sharding.level(sizes, 16)):
        loads[shard] += size
    rest = sorted(loads.values())[:-1]
    assert max(loads.values()) == 100_000 and len(loads) == 16 and rest[-1] - rest[0] <= 0.01 * rest[-1]


def check(rows, given, n):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (k is None, k or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in given)
    by_text, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        by_text[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append((r.slot, r.doc_id if r.doc_id is not None else -1))
    assert all(len(s) == 1 for s in by_text.values())
    for some in slots.values():
        some.sort()
        assert [s for s, _ in some] == list(range(len(some))) and [k for _, k in some] == sorted(k for _, k in some)
    assert all(0 <= s < n for s in slots)


def test_given_documents(spark):
    for sf in (SMALL, SMALL.replace("0.001", "0.01")):
        given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
        rows = workload.op13_sharding(spark, sf).collect()
        check(rows, given, 16)
        loads, groups = defaultdict(int), defaultdict(int)
        for r in rows:
            loads[r.shard] += r.size
            groups[r.text_crc32] += r.size
        share = sum(loads.values()) / 16
        assert {r.law for r in rows} == {"bytes"} and len(loads) == 16
        assert max(loads.values()) - min(loads.values()) <= max(0.03 * share, max(groups.values()))
        assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, workload.op13_sharding(spark, sf).collect()), key=repr)


def test_awkward_rows(spark):
    from pyspark.sql import functions as F
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    docs, given = edge_docs(spark), [(r[0], r[1]) for r in edge_rows()]
    for n in (1, 3, 100):
        check(sharding.numbered(sharding.sharded(docs, n)).select("doc_id", "size", crc, "shard", "slot").collect(), given, n)
    assert sharding.numbered(sharding.sharded(docs.limit(0), 4)).collect() == []
