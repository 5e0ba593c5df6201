"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A document's shingles are its runs of five lower-case words; a shingle weighs its count times an inverse document
frequency, taken over all documents in BUCKETS hashed bins (as feature hashing does), a table of fixed size. Each
of BANDS * ROWS samples takes from a document one shingle and a quantised weight, and two documents take the same
with the probability of their weighted Jaccard similarity. Documents that agree in all samples of a band are
candidates; those whose exact similarity is 0.8 or more are linked, and classes are the connected components.

Inverse frequencies are damped (weights differ by a quarter at most), lest a group of thousands of copies make its
own shingles worthless and the one word that a copy changed decisive.

Copies with equal words are one node from the start. Of a bucket of at most FEW nodes all pairs are verified. Of
a larger one only pairs with its leader, the least node, are at first, so a bucket of n nodes that are all like one
costs n pairs, never n squared. The nodes of buckets that aren't one component then are settled exactly, by prefix
shingles: in one order of all shingles, from rare to frequent among these nodes, two texts at 0.8 or more have a
first common shingle, and at it neither has so much weight behind it that the rest can't make 0.8. So nodes are
grouped by shingle, as far as that holds for any partner, and a pair is verified only if it holds for both of them.
For LEADERS rounds each group gets a hub, one of its nodes at random, and pairs with it alone are verified. After
them, in each group that still holds several components, the nodes outside its largest one meet all the others,
dealt out in blocks; a pair whose parity sketches differ in more places than its texts may differ in weight is left
out. No similar pair that shares a bucket is lost, unless it is in one component already. A pair at 0.8 shares a band
with probability 0.99995.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitmill.llm.repeats import Hashes, mixed
from fitmill.llm.shared import small_batches, text_key, written
from fitmill.llm.substring_dedup import symbols

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 14, 3
BUCKETS = 1 << 18
#: Shingles that are sampled at once.
AT_ONCE = 2048
#: Share of a weight that the inverse document frequency moves, and nodes of a bucket that are paired with each other.
DAMPING, FEW = 0.25, 6
#: Rounds of hubs before all pairs of different components, and nodes of a group that one task pairs with the others.
LEADERS, BLOCK = 3, 256
#: 64-bit words of a sketch, and the share of their summed weights that two similar texts have in common at least.
SKETCH, COMMON = 16, SIMILAR / (1 + SIMILAR)


# one document ------------------------------------------------------------------------

def shingles(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the distinct shingles of a text; fewer than five words are one shingle."""
    words, _ = symbols([data])
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(mixed(Hashes(words).all(min(SHINGLE, len(words)))), return_counts=True)


def bins(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of draws from Gamma(2, 1): r and the logarithm of c; and salts of the samples."""
    draw = np.random.default_rng(11)
    return (draw.gamma(2, 1, 1 << 16), np.log(draw.gamma(2, 1, 1 << 16)),
            draw.integers(1, 1 << 63, BANDS * ROWS).astype(np.uint64))


def samples(h: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One number for each sample: the shingle taken, with its quantised weight."""
    r_table, c_table, salts = _draws()
    log_weight = np.log(weights)[:, None]
    least, out, every = np.full(len(salts), np.inf), np.zeros(len(salts), np.uint64), np.arange(len(salts))
    for k in range(0, len(h), AT_ONCE):
        some = h[k:k + AT_ONCE]
        m = mixed(some[:, None] ^ salts)
        r = r_table[m & np.uint64(0xFFFF)]
        beta = (m >> np.uint64(32)) * 2.0**-32
        t = np.floor(log_weight[k:k + AT_ONCE] / r + beta)
        log_a = c_table[m >> np.uint64(16) & np.uint64(0xFFFF)] - r * (t - beta + 1)
        at = log_a.argmin(0)
        low = log_a[at, every]
        taken = some[at] ^ (t[at, every].astype(np.int64) & 0xFFFF).astype(np.uint64) << np.uint64(48)
        out, least = np.where(low < least, taken, out), np.minimum(low, least)
    return mixed(out)


def band_keys(taken: np.ndarray) -> np.ndarray:
    by_band = taken.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1).astype(np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) ^ by_band[:, k])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (hashes ascending, weights)."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][ia], b[1][ib]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least)) if len(ia) else 0.0


def sketch(h: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 64 * SKETCH bins.

    Sketches of two texts differ in no more places than there are shingles in only one of them, each of which weighs
    one or more.
    """
    parity = np.bincount((h >> np.uint64(30) & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode()


# jobs --------------------------------------------------------------------------------

def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Damped inverse document frequency of each hashed bin, from 1 to 1 + DAMPING, and the number of documents.

    Each task adds up its documents, so it sends one row a bin; the driver gets BUCKETS numbers.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS + 1, np.int64)  # last the documents
        for batch in batches:
            counts[-1] += batch.num_rows
            for text in batch.column("text"):
                counts[np.unique(bins(shingles(_bytes(text.as_py()))[0]))] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bin", "n"])

    rows = docs.select("text").mapInArrow(part, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS + 1)
    counts[[r["bin"] for r in rows]] = [r["n"] for r in rows]
    rare = np.log((1 + counts[-1]) / (1 + np.minimum(counts[:-1], counts[-1]))) / np.log(2 + counts[-1])
    return 1 + DAMPING * rare, int(counts[-1])


def _weighted(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, n = shingles(_bytes(text))
    return h, n * idf[bins(h)]


def _signed(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """doc_id, text_key, node, bands; node and bands are null where there are no words."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, bands = [], []
            for text in batch.column("text"):
                data = _bytes(text.as_py())
                h, n = shingles(data)
                nodes.append(hashlib.md5(b" ".join(data.split())).digest() if len(h) else None)
                bands.append(band_keys(samples(h, n * idf.value[bins(h)])).tolist() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "text_key", "node", "bands"])

    return docs.mapInArrow(part, "doc_id long, text_key long, node binary, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """The pairs (a, b) with whether they are similar; texts has node and text of both."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, None
        for batch in batches:
            like = []
            for k in range(batch.num_rows):
                if (a := batch.column("a")[k].as_py()) != last:
                    last, of_last = a, _weighted(batch.column("text_a")[k].as_py(), idf.value)
                like.append(similarity(of_last, _weighted(batch.column("text_b")[k].as_py(), idf.value)) >= SIMILAR)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(like, pa.bool_())], ["a", "b", "similar"])

    # pairs and texts grow with the corpus, so the plan for large ones is the plan for all
    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(part, "a binary, b binary, similar boolean")


def _prefixes(texts: DataFrame, idf: Broadcast) -> tuple[DataFrame, DataFrame]:
    """Rows node, token, before, weight of the shingles a similar text's first common one can be; rows node, sketch.

    The order is that of frequency among these texts, then of the hash; `before` is the weight of the text's earlier
    shingles. At the first shingle in common with a similar text at least SIMILAR of the weight is left. Shingles of
    one text alone count in the order, but aren't returned.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, tokens, each, sketches = [], [], [], []
            for text in batch.column("text"):
                h, w = _weighted(text.as_py(), idf.value)
                tokens.append(h.view(np.int64))
                each.append(w)
                weights.append(float(w.sum()))
                sketches.append(sketch(h))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(weights, pa.float64()), pa.array(tokens, pa.list_(pa.int64())),
                 pa.array(each, pa.list_(pa.float64())), pa.array(sketches, pa.list_(pa.int64()))],
                ["node", "weight", "tokens", "each", "sketch"])

    rows = written(texts.select("node", "text").mapInArrow(
        part, "node binary, weight double, tokens array<long>, each array<double>, sketch array<long>"))
    each = rows.select("node", "weight", F.explode(F.arrays_zip("tokens", "each")).alias("t")).select(
        "node", "weight", F.col("t.tokens").alias("token"), F.col("t.each").alias("w"))
    often = written(each.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    earlier = W.partitionBy("node").orderBy("n", "token").rowsBetween(W.unboundedPreceding, -1)
    placed = each.join(often.hint("merge"), "token").withColumn("before", F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
    prefixes = placed.where((F.col("before") <= F.col("weight") * (1 - SIMILAR + 1e-9)) & (F.col("n") > 1))
    return written(prefixes.select("node", "token", "before", "weight")), rows.select("node", "sketch")


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """roots(node, root) after the verified pairs found(a, b, similar) of its nodes: only components that they join change."""
    first = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    second = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    edges = written(found.where("similar").join(first, "a").join(second, "b").where("root_a <> root_b").groupBy(
        F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).agg(F.lit(1).alias("_")).drop("_"))
    if edges.isEmpty():
        return roots
    moved = components(edges).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return written(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")))


def _new(pairs: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """Distinct pairs (a, b), a < b, that no round has verified."""
    pairs = pairs.groupBy("a", "b").agg(F.lit(1).alias("_")).drop("_")
    for done in rounds:
        pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
    return written(pairs)


def _could(need_roots: str = "root_a <> root_b") -> Column:
    """Whether rows of one shingle can be a similar pair's first common one: what is left of both suffices."""
    left = F.least(F.col("weight_a") - F.col("before_a"), F.col("weight_b") - F.col("before_b"))
    return F.expr(need_roots) & (left >= (F.col("weight_a") + F.col("weight_b")) * (COMMON - 1e-9))


def _side(rows: DataFrame, side: str) -> DataFrame:
    """The rows with node named as the side and the side in the other names but those that both sides share."""
    return rows.select(*(F.col(c).alias(side if c == "node" else c if c in ("token", "block") else f"{c}_{side}") for c in rows.columns))


def _with_hubs(placed: DataFrame, turn: int) -> DataFrame:
    """Pairs of a node at random of each shingle's, if they have several roots, with the others."""
    groups = written(placed.groupBy("token")
                     .agg(F.min("root").alias("low"), F.max("root").alias("high"),
                          F.max(F.struct(F.xxhash64("node", "token", F.lit(turn)), "node", "root", "weight", "before")).alias("hub"))
                     .where("low <> high").select("token", "hub.node", "hub.root", "hub.weight", "hub.before"))
    both = _side(placed, "b").join(_side(groups, "a"), "token").where(_could())
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _of_components(placed: DataFrame, sketches: DataFrame) -> DataFrame:
    """All pairs of different roots that share a shingle: the nodes outside its largest component with all its nodes."""
    sizes = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    groups = written(sizes.groupBy("token").agg(F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("m"))
                     .where("m > largest.n").select("token", F.col("largest.root").alias("major"),
                                                    F.ceil((F.col("m") - F.col("largest.n")) / BLOCK).cast("int").alias("blocks")))
    words = [F.get("sketch", F.lit(k)).alias(f"s{k}") for k in range(SKETCH)]
    rows = written(placed.join(groups, "token").join(sketches, "node").withColumn("minor", F.col("root") != F.col("major"))
                   .select("token", "node", "root", "weight", "before", "minor", "blocks", *words))
    first = rows.where("minor").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    second = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    apart = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(1, SKETCH)),
                F.bit_count(F.col("s0_a").bitwiseXOR(F.col("s0_b"))))
    once = "root_a <> root_b AND (NOT minor_b OR a < b)"
    near = apart <= (F.col("weight_a") + F.col("weight_b")) * (1 - 2 * COMMON + 1e-9)
    both = _side(first.drop("blocks"), "a").join(_side(second.drop("blocks"), "b"), ["token", "block"]).where(_could(once) & near)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links(docs: DataFrame, nodes: DataFrame, idf: Broadcast) -> DataFrame | None:
    """node and root, the least node of its component, of nodes that may be similar to others; None if there are none.

    nodes has node, doc_id, text_key and bands.
    """
    each_band = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = written(each_band.groupBy("band", "key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    rows = written(each_band.join(buckets, ["band", "key"]))
    few = rows.where(F.col("n") <= FEW).select("band", "key", "node")
    each = (few.withColumnRenamed("node", "a").join(few.withColumnRenamed("node", "b"), ["band", "key"])
            .where("a < b").select("a", "b"))  # of FEW rows a key at most
    large = rows.where(F.col("n") > FEW)
    led = large.where(F.col("node") > F.col("least")).select(F.col("least").alias("a"), F.col("node").alias("b"))
    pairs = _new(each.unionByName(led), [])
    if pairs.isEmpty():
        return None
    wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))))
    mine = written(nodes.join(wanted, "node", "left_semi").select("node", "doc_id", "text_key"))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_key") == F.col("r.text_key"))
    texts = written(docs.alias("d").join(mine.alias("r").hint("merge"), same).groupBy("r.node").agg(F.first("d.text").alias("text")))
    rounds = [written(_verified(pairs, texts, idf))]
    roots = written(mine.select("node").join(components(rounds[0].where("similar").select("a", "b")), "node", "left")
                    .select("node", F.coalesce("root", "node").alias("root")))

    # large buckets of more than one component
    placed = written(large.select("band", "key", "node").join(roots, "node"))
    parted = placed.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    left = written(placed.join(parted, ["band", "key"], "left_semi").select("node").distinct())
    if left.isEmpty():
        return roots
    prefixes, sketches = _prefixes(texts.join(left.hint("merge"), "node", "left_semi"), idf)
    for turn in range(LEADERS + 1):
        placed = written(prefixes.join(roots, "node"))
        pairs = _new(_with_hubs(placed, turn) if turn < LEADERS else _of_components(placed, sketches), rounds)
        if not pairs.isEmpty():
            rounds.append(written(_verified(pairs, texts, idf)))
            roots = _merged(roots, rounds[-1])
    return roots


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of the component of each node that edges(a, b) name."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        near = written(both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                       .agg(F.min("root").alias("near")))
        nearer = written(roots.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old")))
        # and from there to the root that its root has by now
        step = nearer.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = written(nearer.join(step, "root").select("node", F.col("next").alias("root"), "old"))
        if new.where("root <> old").isEmpty():
            return new.select("node", "root")
        roots = new.drop("old")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, class_id, class_key, n_class of each row of docs(doc_id, text).

    class_id and class_key are doc_id and key of text of the class's first document, in the order of both, a
    null doc_id first; n_class counts rows. A document without words (null and empty texts too) is like no other;
    rows that repeat its doc_id and text are in one class. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key().alias("text_key"))
    idf = docs.sparkSession.sparkContext.broadcast(frequencies(docs)[0])
    signed = written(_signed(docs, idf))
    nodes = written(signed.where("node IS NOT NULL").groupBy("node")
                    .agg(F.min(F.struct("doc_id", "text_key", "bands")).alias("f")).select("node", "f.*"))
    roots = links(docs, nodes, idf)
    members = signed.select("doc_id", "text_key", F.coalesce("node", F.concat(
        F.lit("no words ").cast("binary"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"),
        F.lit(" ").cast("binary"), F.coalesce(F.col("text_key").cast("string"), F.lit("")).cast("binary"))).alias("node"))
    if roots is not None:
        members = (members.join(roots, "node", "left")
                   .withColumn("node", F.coalesce("root", "node")).drop("root"))
    members = written(members)
    heads = written(members.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("f"), F.count(F.lit(1)).alias("n_class"))
                    .select("node", F.col("f.doc_id").alias("class_id"), F.col("f.text_key").alias("class_key"), "n_class"))
    return members.join(heads, "node").select("doc_id", "text_key", "class_id", "class_key", "n_class")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of docs for each class, its first, with all columns."""
    heads = classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("text_key").eqNullSafe(F.col("class_key")))
    heads = written(heads.select(F.col("class_id").alias("_id"), F.col("class_key").alias("_key")).distinct())
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").cast("long").alias("id"), text_key(F.col("text").cast("string")).alias("key"))
    same = F.col("k.id").eqNullSafe(F.col("h._id")) & F.col("k.key").eqNullSafe(F.col("h._key"))
    kept = rows.alias("k").join(heads.alias("h"), same, "left_semi")
    nth = F.row_number().over(W.partitionBy("id", "key").orderBy(F.lit(0)))  # rows that repeat one document
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*")
