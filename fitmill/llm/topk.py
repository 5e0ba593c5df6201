"""Exact top-k by inner product of integer vectors, with multi-resolution segment statistics.

A vector is cut into 1, 4 and 16 segments; of each the mean and the deviation (length of what is left) are
known. Over a segment of length n the inner product is at most n * mean * mean' + deviation * deviation'
(Cauchy-Schwarz on the rests), which is the lower bound of a distance turned round. For each block of queries
and block of candidates the bounds go from coarse to fine; a candidate stays for a query as long as its bound
reaches the k-th best exact score known there, and what stays last is scored exactly. Queries meet candidates
in blocks: a block of candidates is sent once, and the blocks of queries, the smaller side, once to each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitmill.llm.shared import written

SEGMENTS = (1, 4, 16)
QUERIES_A_BLOCK = 256
CANDIDATES_A_BLOCK = 4096


def _block(table: pa.Table) -> pa.Table:
    """Packs the rows of a block into one: ids, ascending, and vectors as i64."""
    order = np.argsort(ids := table.column("vec_id").to_numpy(), kind="stable")
    rows = [v.values.to_numpy(zero_copy_only=False) for v in table.column("vector")]
    wide = np.zeros((len(ids), max(map(len, rows))), np.float64)
    for i, k in enumerate(order):
        wide[i, :len(rows[k])] = rows[k]
    return pa.table({"block": [table.column("block")[0].as_py()], "ids": [ids[order].astype("<i8").tobytes()],
                     "vectors": [np.floor(64 * wide).astype("<i8").tobytes()]})


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose products sum to the bound: root of length times mean, and deviation, of each segment."""
    parts = [p for p in np.array_split(x, segments, axis=1) if p.shape[1]]
    means = np.stack([p.mean(1) for p in parts], 1)
    rests = np.stack([np.sqrt(((p - m[:, None]) ** 2).sum(1)) for p, m in zip(parts, means.T)], 1)
    return np.hstack([means * np.sqrt([p.shape[1] for p in parts]), rests])


def best_in_block(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, candidate, score) of the k best of a block for each query; x_ids ascending, own id left out."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (q, x))
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * width < 2**50
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    own = q_ids[:, None] == x_ids[None, :]
    if exact and len(x_ids) > 4 * k:
        norms = np.sqrt((qf ** 2).sum(1)) * np.sqrt((xf ** 2).sum(1).max())
        at_least, alive = np.full(len(q), -np.inf), np.arange(len(x))
        for segments in SEGMENTS:
            bound = _statistics(qf, segments) @ _statistics(xf[alive], segments).T
            bound[own[:, alive]] = -np.inf
            some = np.argpartition(-bound, min(2 * k, len(alive) - 1), axis=1)[:, :2 * k]  # likely ones set the bar
            seen = np.einsum("qd,qkd->qk", qf, xf[alive[some]])
            seen[np.take_along_axis(own[:, alive], some, 1)] = -np.inf
            if seen.shape[1] >= k:
                at_least = np.maximum(at_least, -np.partition(-seen, k - 1, axis=1)[:, k - 1])
            stays = (bound >= (at_least - 0.5 - 1e-9 * norms)[:, None]).any(0)
            alive = alive[stays]
            if len(alive) <= 4 * k:
                break
        x_ids, xf, own = x_ids[alive], xf[alive], own[:, alive]
        scores = np.rint(qf @ xf.T).astype(np.int64)
    else:
        scores = q @ x.T
    for i, row in enumerate(scores):
        order = np.flatnonzero(~own[i])
        if len(order) > k:
            bar = np.partition(row[order], len(order) - k)[len(order) - k]
            order = order[row[order] >= bar]
        order = order[np.lexsort((x_ids[order], -row[order]))][:k]
        yield q_ids[i], x_ids[order], row[order]


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each query among vectors(vec_id, embedding) its k best other rows.

    Components become floor(64 * x). Ties go to the smaller vec_id. Rows without a vec_id, and vectors that
    are null or hold a null, NaN or infinity, take no part. A repeated vec_id counts once, with the smallest
    of its vectors; shorter vectors are filled up with zeros. With fewer than k others all of them are given;
    an empty table gives no rows. Other columns are not read. is_query is a condition on vec_id.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
            .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
            .agg(F.min(F.col("embedding").cast("array<double>")).alias("vector")))
    rows = written(rows)
    n_blocks = 1 + rows.count() // CANDIDATES_A_BLOCK

    def packed(some: DataFrame, n: int) -> DataFrame:
        dealt = some.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)))
        return dealt.groupBy("block").applyInArrow(_block, "block long, ids binary, vectors binary")

    asking = packed(rows.where(is_query), 1 + rows.where(is_query).count() // QUERIES_A_BLOCK)
    sent = asking.select(F.col("ids").alias("q_ids"), F.col("vectors").alias("q"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"))
    pairs = packed(rows, n_blocks).join(sent, "block")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, x_ids = (np.frombuffer(batch.column(c)[row].as_py(), "<i8") for c in ("q_ids", "ids"))
                q, x = (np.frombuffer(batch.column(c)[row].as_py(), "<i8").reshape(len(i), -1)
                        for c, i in (("q", q_ids), ("vectors", x_ids)))
                found = list(best_in_block(q_ids, q, x_ids, x, k))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q_ids, [len(f[1]) for f in found])),
                    pa.array(np.concatenate([f[1] for f in found])),
                    pa.array(np.concatenate([f[2] for f in found]))], ["query_id", "vec_id", "score"])

    best = pairs.mapInArrow(score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

