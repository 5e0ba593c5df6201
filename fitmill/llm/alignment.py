"""Cross-tokenizer alignment by galloping intersection of token ends.

Each text is encoded by two tokenizers. The shorter list of byte ends drives the search into the longer one: block
by block an exponential search finds how far the block reaches, a binary search ranks its ends within. Ends that
occur in both lists cut the tokens into groups, and the differences of successive ranks give the range of tokens
that each token overlaps.

A text is encoded once; its figures and its linked id pairs are written in pieces of at most PIECE pairs. Counts of
pairs are sums over all texts. Pairs that hold more than one of 2^HOT links are fewer than 2^HOT, so their counts
can be broadcast; the others join by pair, and none of those is a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.llm.shared import written
from fitmill.llm.tokens import Encoder

#: Ends of the shorter list that are ranked at once.
BLOCK = 1024
#: Pairs of a written row, characters encoded at once.
PIECE, CHUNK = 1 << 16, 1 << 20
#: Pairs are hot above total / 2^HOT links.
HOT = 17
#: Where the second tokenizer's ids begin in a pair's code: code = first * IDS + second.
IDS = 1 << 20


# two lists of ends -------------------------------------------------------------------

def ranks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each end of the shorter list the number of lesser ends in the longer one; both ascend."""
    out, place = np.empty(len(short), np.int64), 0
    for k in range(0, len(short), BLOCK):
        block, step = short[k:k + BLOCK], len(short[k:k + BLOCK])
        while place + step < len(long) and long[place + step] < block[-1]:
            step *= 2
        out[k:k + len(block)] = place + np.searchsorted(long[place:place + step + 1], block)
        place = int(out[k + len(block) - 1])
    return out


def aligned(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two lists with the same last end: last tokens of the groups in a and b, links as places in a and b."""
    swap = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank = ranks(short, long)
    common = long[rank] == short
    first = np.concatenate(([0], (rank + common)[:-1]))  # an end in both lists leaves its token behind
    n = rank - first + 1
    mine = np.repeat(np.arange(len(short)), n)
    theirs = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
    cut, other = np.flatnonzero(common), rank[common]
    return (other, cut, theirs, mine) if swap else (cut, other, mine, theirs)


# texts -------------------------------------------------------------------------------

def _bytes_of_characters() -> dict[str, int]:
    """Byte-level characters: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self.a = Encoder(path_a)
        self.a.tokenizer.encode_special_tokens = True  # their strings in texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = _bytes_of_characters()
        self.bytes_a = [b""] * self.a.tokenizer.get_vocab_size()
        for token, k in self.a.tokenizer.get_vocab().items():
            self.bytes_a[k] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in enumerate(pieces)]
        if len(pieces) > IDS:
            raise ValueError(f"more than {IDS} pieces")
        self.size_a, self.size_b = (np.array([len(x) for x in some]) for some in (self.bytes_a, self.bytes_b))
        self.words_a = np.array([f"{k}{end}" for end in ",|" for k in range(len(self.bytes_a))], object)
        self.words_b = np.array([f"{k}{end}" for end in ",;" for k in range(len(pieces))], object)

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each text; nothing where they don't give back the text."""
        first = self.a.encode([" " + t for t in texts])
        second = self.b.encode(texts, out_type=int, num_threads=1)
        for text, a, b in zip(texts, first, second):
            whole, a = f" {text}".encode(), np.frombuffer(a, "<u4").astype(np.int64)
            same = text and all(b"".join(map(some.__getitem__, ids)) == whole
                                for some, ids in ((self.bytes_a, a.tolist()), (self.bytes_b, b)))
            yield (a, np.array(b, np.int64)) if same else None

    def groups(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        """The groups as a1,a2|b1;a3|b2,b3."""
        size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        out = np.empty(len(a) + len(b), object)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a], last_b[cut_b] = len(self.bytes_a), len(self.bytes_b)
        out[np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = self.words_a[a + last_a]
        out[np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)] = self.words_b[b + last_b]
        return "".join(out.tolist())[:-1]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# jobs --------------------------------------------------------------------------------

_FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _FIGURES),
                     ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
_DDL = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<long>")


def links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Figures and linked id pairs of docs(doc_id, text), written: row, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs, times.

    A document's pairs may take several rows of the same `row`; its figures stand in the first, null in the others.
    A null or empty text, or one that either tokenizer changes, has zeros, no pairs and an empty groups_sha256.
    Repeated rows and ids are documents of their own; a null doc_id stays null. An empty table gives none. Other
    columns are not read.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, row, held, size = aligner(path_a, path_b), TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            ids, texts, k = batch.column("doc_id").to_pylist(), batch.column("text"), 0
            while k < len(ids):
                some, chars = [], 0
                while k + len(some) < len(ids) and (not some or chars < CHUNK):
                    some.append(texts[k + len(some)].as_py() or "")
                    chars += len(some[-1])
                for doc_id, found in zip(ids[k:k + len(some)], tool.encoded(some)):
                    head, pairs, times = (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)
                    if found:
                        a, b = found
                        cut_a, cut_b, of_a, of_b = aligned(np.cumsum(tool.size_a[a]), np.cumsum(tool.size_b[b]))
                        pairs, times = np.unique(a[of_a] * IDS + b[of_b], return_counts=True)
                        digest = hashlib.sha256(tool.groups(a, b, cut_a, cut_b).encode()).hexdigest()
                        head = (len(a), len(b), len(cut_a), len(of_a), digest)
                    for at in range(0, max(len(pairs), 1), PIECE):
                        held.append((row, doc_id, *(head if not at else [None] * 5), pairs[at:at + PIECE], times[at:at + PIECE]))
                        size += 1 + len(held[-1][-1])
                        if size > 4 * PIECE:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)
                            held, size = [], 0
                    row += 1
                k += len(some)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _SCHEMA)], schema=_SCHEMA)

    return written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(part, _DDL))


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n, best: links that hold each id pair, and whether no pair of its second id has more. Written."""
    one = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counted = written(one.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")))
    second = F.col("pair") % IDS
    most = counted.groupBy(second.alias("second")).agg(F.max("n").alias("most"))  # a row an id of the vocabulary
    both = counted.join(F.broadcast(most), second == F.col("second"))
    return written(both.select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def alignment(found: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document of links()."""
    counts = pair_counts(found)
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > total / (1 << HOT))
    cold = counts.where(F.col("n") <= total / (1 << HOT))
    n = F.lit(None).cast("long")
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    met = each.join(F.broadcast(hot), "pair", "left")
    # a document's hot links are summed where they are; only cold ones are shuffled by pair
    near = met.where("n IS NOT NULL")
    far = met.where("n IS NULL").drop("n", "best").join(cold.hint("merge"), "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    heads = found.where("n_a IS NOT NULL").select("row", "doc_id", *_FIGURES, "groups_sha256",
                                                  F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    columns = heads.columns
    parts = [heads]
    for some in (near, far):
        summed = some.groupBy("row").agg(*sums)
        parts.append(summed.select("row", *[(F.lit(None).cast("string") if c == "groups_sha256" else n).alias(c)
                                            for c in columns[1:-2]], "n_best", "count_sum"))
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("row").agg(
        *[F.max(c).alias(c) for c in columns[1:-2]], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return merged.select("doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256")
