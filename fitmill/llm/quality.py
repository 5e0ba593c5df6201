"""Quality by random indexing and a small network.

Every word has an index vector: a few +1 and -1 at places that a hash of the word names. A word's vector is its
own index vector and the sum of those of its neighbours in the sample, at unit length. A document is the mean of
its words' vectors, frequent words weighing less; runs of marks are words too, and so are three signs: a word the
sample doesn't have, a word repeated at once, a word in capitals. Two layers map that mean to a logit, which a
temperature fitted on rows that the network didn't learn from turns into a calibrated probability.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.llm.labelled import held_out, sample
from fitmill.llm.shared import small_batches

#: Labelled documents to learn from, at most, and the longest of them in characters.
ROWS, MOST_CHARS = 6000, 50_000
#: Words with vectors, at most, and the least number of sample documents that they are in.
WORDS, LEAST_DOCS = 20_000, 3
DIMENSIONS, NONZERO, NEIGHBOURS, RARE = 128, 8, 2, 1e-3
#: So many average words are added to each document, lest a few words make an outlier of a short one.
ADDED = 20
#: Neighbours counted at once, and vectors gathered at once.
PIECE, GATHERED = 500_000, 10_000
HIDDEN, ROUNDS, RATE, DECAY, CALIBRATION = 32, 600, 0.01, 1e-4, 5
_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
_CAPITALS = re.compile(r"\b[^\W\d_a-z]{2,}\b")
SIGNS = [b" unknown", b" repeated", b" capitals"]


def index_vectors(words: list[bytes]) -> np.ndarray:
    """Rows of DIMENSIONS with NONZERO places of +1 or -1, drawn from the word's hash."""
    seeds = np.array([zlib.crc32(w) for w in words], np.uint64)
    out = np.zeros((len(words), DIMENSIONS), np.float32)
    for k in range(NONZERO):
        mixed = (seeds + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        np.add.at(out, (np.arange(len(words)), (mixed % np.uint64(DIMENSIONS)).astype(int)),
                  np.where(mixed >> np.uint64(40) & np.uint64(1), 1, -1))
    return out


@dataclass
class Model:
    number: dict[bytes, int]
    vectors: np.ndarray  # a row for each word, then the signs; times the word's weight
    usual: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def pooled(self, text: str | None) -> np.ndarray:
        return pool(text, self.number, self.vectors, self.usual)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = (np.array([self.pooled(t) for t in texts]).reshape(len(texts), -1) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(_forward(self.layers, x)[1] / self.temperature, -40, 40)))


def tokens(text: str | None) -> list[bytes]:
    return _TOKEN.findall((text or "").encode())


def pool(text: str | None, number: dict[bytes, int], vectors: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Mean vector of the whole text's words and signs, and of ADDED usual words; the latter alone if it is empty."""
    found = tokens(text)
    if not found:
        return usual
    ids = np.fromiter(map(number.get, map(bytes.lower, found), [len(number)] * len(found)), np.int64, len(found))
    repeated = sum(map(operator.eq, found[1:], found))
    total = sum((vectors[ids[k:k + GATHERED]].sum(0) for k in range(0, len(ids), GATHERED)), np.zeros(vectors.shape[1]))
    total += repeated * vectors[-2] + len(_CAPITALS.findall(text)) * vectors[-1]
    return ((total + ADDED * usual) / (len(found) + ADDED)).astype(np.float32)


def _sums(ids: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    """Adds the rows of values to the rows of out that ids name."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    starts = np.flatnonzero(np.diff(ids, prepend=-1))
    out[ids[starts]] += np.add.reduceat(values[order], starts)


def word_vectors(texts: list[str]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Numbers and weighted vectors of the sample's words, and of the signs behind them; their mean in use.

    The texts are cut into words twice, so that no more than one text's words are held at a time; beside the
    texts there are four bytes a word of the sample.
    """
    seen = Counter()
    for t in texts:
        seen.update(set(map(bytes.lower, tokens(t))))
    number = {w: k for k, (w, n) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:WORDS]) if n >= LEAST_DOCS}
    del seen
    names = [*number, *SIGNS]
    own = index_vectors(names)
    vectors, counts = own * 1.0, np.zeros(len(names))
    ids = np.concatenate([np.fromiter(map(number.get, map(bytes.lower, found), repeat(len(number))), np.int32, len(found))
                          for found in map(tokens, texts)])
    counts += np.bincount(ids, minlength=len(names))
    for far in range(1, NEIGHBOURS + 1):
        for k in range(0, len(ids) - far, PIECE):  # neighbours across the end of a document are few enough
            piece = ids[k:k + PIECE + far].astype(np.int64)
            pairs, n = np.unique(piece[:-far] * len(names) + piece[far:], return_counts=True)
            for at in range(0, len(pairs), GATHERED):
                some, times = pairs[at:at + GATHERED], (n[at:at + GATHERED, None] / 20).astype(np.float32)
                left, right = some // len(names), some % len(names)
                _sums(left, own[right] * times, vectors)
                _sums(right, own[left] * times, vectors)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    vectors = vectors * 0.5 + own / np.sqrt(NONZERO) * 0.5  # neighbours must not blur the word itself
    common = counts / max(counts.sum(), 1)
    common[-3:] = 0
    weighted = (vectors * (RARE / (RARE + common))[:, None]).astype(np.float32)
    return number, weighted, (counts @ weighted / max(counts.sum(), 1)).astype(np.float32)


def _forward(layers: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = layers
    hidden = np.tanh(x @ a + b)
    return hidden, hidden @ c + d


def _train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adam on the log loss of a network of two layers, from fixed random weights."""
    draw = np.random.default_rng(7)
    layers = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN),
              np.array(np.log(y.mean() / (1 - y.mean())))]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, ROUNDS + 1):
        hidden, logit = _forward(tuple(layers), x)
        error = (1 / (1 + np.exp(-logit)) - y) / len(y)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [x.T @ back + DECAY * layers[0], back.sum(0), hidden.T @ error + DECAY * layers[2], error.sum()]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            layers[k] = layers[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def fit(rows: list[tuple[int, str]]) -> Model | float:
    """A model of the rows; where they don't hold both labels, the one score for all (0.5 without rows)."""
    y = np.array([y for y, _ in rows], float)
    if len(set(y)) < 2:
        return float(y[0]) if len(y) else 0.5
    number, vectors, usual = word_vectors([t for _, t in rows])
    x = np.array([pool(t, number, vectors, usual) for _, t in rows], np.float64)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - centre) / scale
    aside = np.arange(len(y)) % CALIBRATION == 0
    if len(set(y[~aside])) < 2:
        aside[:] = False
    layers = _train(x[~aside], y[~aside])
    logit = _forward(layers, x[aside] if aside.any() else x)[1]
    truth = y[aside] if aside.any() else y
    tried = np.geomspace(0.25, 8, 61)
    loss = [np.logaddexp(0, np.where(truth == 1, -1, 1) * logit / t).mean() for t in tried]
    return Model(number, vectors, usual, centre, scale, layers, float(tried[int(np.argmin(loss))]))


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, most_chars: int = MOST_CHARS) -> Model | float:
    """A model from docs(doc_id, text) and labels(doc_id, quality), without the rows that are held out."""
    return fit(sample(docs, labels, "quality", 4, 2, rows, most_chars))


def _scores(model: Model | float, texts: list[str | None]) -> np.ndarray:
    return np.full(len(texts), model) if isinstance(model, float) else model.scores(texts)


def scored(docs: DataFrame, model: Model | float, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs.

    Whole texts; null and empty ones get the score of a document without words. Repeated rows are scored one
    by one. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(_scores(sent.value, batch.column("text").to_pylist()), pa.float64())
            yield batch.drop_columns(["text"]).append_column("score", score)

    rows = docs.select(F.col("doc_id").cast("long"), held_out(4, 2).alias("held_out"), F.col("text").cast("string"))
    out = rows.mapInArrow(part, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def accepted(docs: DataFrame, model: Model | float, least: float = 0.7) -> DataFrame:
    """The rows of docs that score `least` or more, with all their columns."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(sent.value, batch.column("text").to_pylist()) >= least))

    return docs.mapInArrow(part, docs.schema)
