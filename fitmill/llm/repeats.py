"""Windows that also start earlier in the corpus: the plan that both exact span deduplications share.

A document is a sequence of symbols, a window is `length` of them in a row, and a window is a repeat if its symbols
also start earlier: in a row with a smaller (doc_id, key of text), null first, or in the same at a smaller place.

Windows of all documents can't be sorted as they are (a row for each byte). But equal windows have equal least
hashes among their pieces of `piece` symbols, so neighbouring windows with the same least hash, a stretch, travel
as one row, and equal windows are in stretches of the same hash. Then:

1. hashes that occur once are left behind (a count of hashes, added up before the shuffle);
2. a stretch whose whole content occurs earlier is repeats throughout (the least place of each content, likewise);
3. first stretches that share a hash with different ones, or hold a hash twice, are compared window by window in
   buckets of bounded size, by the operator's own method. A hash with many different stretches is parted over
   several buckets, and windows that are first in their bucket meet once more by digest, as a least place of each.

No step gathers a key's rows in one task: counts and least places are pre-aggregated, joins with them are plain
joins that the adaptive planner splits, and buckets are parted by count. Whole texts move twice: to the comparison
and to the result. Rows alike in doc_id and text are one document and get the same answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.llm.shared import text_key, written

#: Stretches in a bucket, about, and of one hash in it, at most about.
BUCKET, OF_ONE_HASH = 4096, 1024
#: Bytes of text that are hashed at once, about, and rows that are sent at once.
CHUNK, SENT = 1 << 17, 4096
_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for 2**bits places."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(1 << bits, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Hashes of any piece of a sequence, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, symbols: np.ndarray, base: int = _BASE) -> None:
        self.power, self.inverse = _powers(base, max(18, int(len(symbols) + 1).bit_length()))
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self.power[:len(symbols)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.inverse[begin]

    def all(self, size: int) -> np.ndarray:
        """Of every piece of this size."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.inverse[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def _over(values: np.ndarray, size: int, take) -> np.ndarray:
    """Least or largest of each `size` values in a row."""
    done = 1
    while 2 * done <= size:
        values = take(values[:-done], values[done:])
        done *= 2
    return take(values[:len(values) - size + done], values[size - done:]) if done < size else values


@dataclass
class Kind:
    """What the operators differ in."""

    length: int
    piece: int
    symbols: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]  # of texts in a row, and where each ends
    content: Callable[[bytes, list[tuple[int, int]]], list[bytes]]  # of ranges of symbols
    repeats: Callable[[list[bytes], np.ndarray], list[np.ndarray]]  # of contents in corpus order, with their hashes: masks
    digests: Callable[[bytes, np.ndarray], list[bytes]]  # of windows of a content


def stretches(symbols: np.ndarray, ends: np.ndarray, length: int, piece: int) -> tuple[np.ndarray, ...]:
    """Of each stretch of documents in a row: document, hash, hash of content, first window, windows, hash in it twice.

    ends says where each document ends; windows don't cross it, and first windows count from its beginning.
    """
    width = length - piece + 1
    if len(symbols) < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, bool))
    starts = np.concatenate(([0], ends[:-1]))
    document = np.repeat(np.arange(len(ends)), ends - starts)[:len(symbols) - length + 1]
    whole = np.arange(len(document)) + length <= ends[document]
    h = mixed(Hashes(symbols).all(piece))
    least = np.where(whole, _over(h, width, np.minimum), np.uint64(0))
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (document[1:] != document[:-1])))
    begin = np.flatnonzero(new & whole)
    if not len(begin):
        return stretches(symbols[:0], ends[:0], length, piece)
    of = document[begin]
    end = np.minimum(np.append(begin[1:], len(least)), ends[of] - length + 1)
    # places of least pieces: those whose hash is the largest of the least ones of the windows around it
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    places = np.flatnonzero(h == _over(padded, width, np.maximum))
    low, high = np.searchsorted(places, begin), np.searchsorted(places, end + width - 2, "right")
    sizes = high - low
    firsts = np.cumsum(sizes) - sizes
    within = places[np.arange(sizes.sum()) - np.repeat(firsts - low, sizes)]
    twice = np.add.reduceat((h[within] == np.repeat(least[begin], sizes)).astype(np.int64), firsts) > 1
    other = Hashes(symbols, _OTHER).of(begin, end - 1 + length)
    return of, least[begin], mixed(other ^ (end - begin).astype(np.uint64)), begin - starts[of], end - begin, twice


def _chunks(texts: list[str | None]) -> Iterator[list[bytes]]:
    """Texts in UTF-8, some at a time, so that arrays are long enough to be worth their call and fit a cache."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode())
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _marks(docs: DataFrame, kind: Kind) -> DataFrame:
    names = ["hash", "content", "doc_id", "text_key", "place", "n"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, first = [], 0
            for chunk in _chunks(batch.column("text").to_pylist()):
                of, *rest = stretches(*kind.symbols(chunk), kind.length, kind.piece)
                found.append((of + first, *rest))
                first += len(chunk)
            if found:
                at, h, content, place, n, twice = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(content.view(np.int64)), batch.column("doc_id").take(pa.array(at)),
                     batch.column("text_key").take(pa.array(at)), pa.array(place), pa.array(2 * n + twice)], names)

    return docs.mapInArrow(part, ", ".join(f"{c} long" for c in names))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key().alias("text_key"))


def _row_is(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.text_key").eqNullSafe(F.col(f"{b}.text_key"))


def repeats(docs: DataFrame, kind: Kind) -> DataFrame:
    """doc_id, text_key, place, n: ranges of windows (first, how many) that are repeats, over whole texts.

    docs(doc_id, text); a null text is empty, and a text shorter than a window has none.
    """
    docs = _keyed(docs)
    marks = _marks(docs, kind)
    twice = F.col("n") % 2 == 1
    shared = written(marks.groupBy("hash").agg(F.count(F.lit(1)).alias("times"), F.max(twice).alias("twice"))
                     .where("times > 1 OR twice").select("hash"))
    hits = written(marks.join(shared, "hash"))
    place = F.struct("doc_id", "text_key", "place", "n")
    first = written(hits.groupBy("hash", "content").agg(F.min(place).alias("f"))
                    .select("hash", "content", "f.*"))
    again = written(hits.alias("h").join(first.alias("f"), ["hash", "content"])
                    .where(~(_row_is("h", "f") & (F.col("h.place") == F.col("f.place"))))
                    .select("h.doc_id", "h.text_key", "h.place", F.floor(F.col("h.n") / 2).cast("long").alias("n")))
    several = written(first.groupBy("hash").agg(F.count(F.lit(1)).alias("times"), F.max(twice).alias("twice"))
                      .where("times > 1 OR twice").select("hash", "times"))
    todo = first.join(several, "hash")
    n_buckets = 1 + (several.agg(F.sum("times")).first()[0] or 0) // BUCKET
    parts = F.ceil(F.col("times") / OF_ONE_HASH)
    todo = todo.withColumn("bucket", F.pmod(F.xxhash64("hash", F.pmod(F.col("content"), parts)), F.lit(n_buckets)))
    lists = todo.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(
        "bucket", "hash", (parts > 1).alias("parted"), "place", F.floor(F.col("n") / 2).cast("long").alias("n"))).alias("todo"))
    texts = docs.alias("d").join(lists.alias("l"), _row_is("d", "l")).select("d.doc_id", "d.text_key", "d.text", "l.todo")
    compared = written(_compared(texts, kind))
    sure = compared.where("digest IS NULL").drop("digest")
    unsure = compared.where("digest IS NOT NULL")
    firsts = written(unsure.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key", "place")).alias("f"))
                     .select("digest", "f.*"))
    late = written(unsure.alias("u").join(firsts.alias("f"), "digest")
                   .where(~(_row_is("u", "f") & (F.col("u.place") == F.col("f.place"))))
                   .select("u.doc_id", "u.text_key", "u.place", "u.n"))
    return again.unionByName(sure).unionByName(late)  # three written tables


def _compared(texts: DataFrame, kind: Kind) -> DataFrame:
    """Cuts stretches out of texts and compares those of a bucket: ranges of repeats, or windows to compare by digest."""
    names = ["bucket", "hash", "parted", "doc_id", "text_key", "place", "content"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("todo")
            counts = rows.value_lengths().to_numpy(zero_copy_only=False)
            todo = rows.flatten()
            place, n = todo.field("place").to_numpy(), todo.field("n").to_numpy()
            begins = np.concatenate(([0], np.cumsum(counts)))
            contents, sent, first = [], 0, 0
            for k, text in enumerate(batch.column("text")):
                some = slice(begins[k], begins[k + 1])
                ranges = zip(place[some].tolist(), (place[some] + n[some] - 1 + kind.length).tolist())
                contents += kind.content((text.as_py() or "").encode(), list(ranges))
                if len(contents) >= SENT or k + 1 == batch.num_rows:
                    at = pa.array(np.repeat(np.arange(first, k + 1), counts[first:k + 1]))
                    fields = [todo.field(c).slice(sent, len(contents)) for c in ("bucket", "hash", "parted", "place")]
                    yield pa.RecordBatch.from_arrays(
                        [*fields[:3], batch.column("doc_id").take(at), batch.column("text_key").take(at), fields[3],
                         pa.array(contents, pa.binary())], names)
                    sent, first, contents = sent + len(contents), k + 1, []

    def compare(table: pa.Table) -> pa.Table:
        # in corpus order; rows of the same place are the same window of repeated rows, and one is enough
        rows = sorted({((r["doc_id"] is not None, r["doc_id"] or 0), r["text_key"], r["place"]): r
                       for r in table.to_pylist()}.items())
        rows = [r for _, r in rows]
        masks = kind.repeats([r["content"] for r in rows], np.array([r["hash"] for r in rows], np.int64))
        out = []
        for r, mask in zip(rows, masks):
            edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            out += [(r["doc_id"], r["text_key"], r["place"] + int(b), int(e - b), None) for b, e in zip(edges[::2], edges[1::2])]
            if r["parted"]:
                left = np.flatnonzero(~mask)
                out += [(r["doc_id"], r["text_key"], r["place"] + int(k), 1, d)
                        for k, d in zip(left, kind.digests(r["content"], left))]
        columns = zip(*out) if out else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "text_key", "place", "n", "digest"])

    cuts = texts.mapInArrow(cut, "bucket long, hash long, parted boolean, doc_id long, text_key long, place long, content binary")
    return cuts.groupBy("bucket").applyInArrow(compare, "doc_id long, text_key long, place long, n long, digest binary")


def with_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text, places, counts of each row of docs: its ranges of repeated windows, null if there are none."""
    lists = found.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("place", "n")).alias("r"))
    both = _keyed(docs).alias("d").join(lists.alias("l"), _row_is("d", "l"), "left")
    return both.select("d.doc_id", "d.text", F.col("l.r.place").alias("places"), F.col("l.r.n").alias("counts"))


def covered(n: int, length: int, places: list[int] | None, counts: list[int] | None) -> np.ndarray:
    """Mask of the symbols inside repeated windows."""
    if not places:
        return np.zeros(n, bool)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.array(places), 1)
    np.add.at(edges, np.array(places) + np.array(counts) - 1 + length, -1)
    return np.cumsum(edges[:n]) > 0
