"""Exact search against brute force."""

import math
import random

import duckdb
from pyspark.sql import functions as F

from fitmill.llm import topk, workload
from tests.llm.data import SMALL


def brute(rows, is_query, k):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, v), v)
    whole = {i: [math.floor(64 * x) for x in v] for i, v in kept.items()}
    out = []
    for q in filter(is_query, whole):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_awkward_vectors(spark):
    draw = random.Random(3)
    rows = [(k, [draw.choice([-1.0, 0.0, 0.5, 0.25]) for _ in range(10)]) for k in range(400)]  # many ties
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 10), (503, [float("inf")] * 10), (None, [1.0] * 10),
             (504, [0.5, 0.5]), (505, []), (20, [9.0] * 10), (7, rows[7][1]), (520, [1e6] * 10), (540, [0.1] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("x")).withColumn("score", F.lit(0))
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, 20).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 20)
    few = df.where("vec_id < 5")
    assert len(topk.search(few, F.col("vec_id") == 0, 20).collect()) == 4
    assert topk.search(df.limit(0), F.col("vec_id") == 0, 20).collect() == []


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES_A_BLOCK", 150)
    monkeypatch.setattr(topk, "QUERIES_A_BLOCK", 7)
    draw = random.Random(5)
    rows = [(k, [draw.gauss(0, 1) for _ in range(32)]) for k in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, 20).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 20)


def test_given_vectors(spark):
    got = sorted(tuple(r) for r in workload.op10_top_vectors(spark, SMALL).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{SMALL}/embeddings.parquet'")
    assert got == sorted(con.execute(workload.SQL["op10_top_vectors"]).fetchall())
