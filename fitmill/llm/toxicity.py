"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence's logit is a bias and the weights of its distinct words; its probability p is the logistic of that.
A word weighs what it and its beginnings weigh together, since insults come with many endings. Only features that
toxic sample documents hold far oftener than chance would have it are given weights at all.
A document is toxic if any sentence is, so its score is the noisy-or 1 - prod(1 - p). The weights are fitted
to document labels through that formula, so the sentences that carry the label get the probability, and
`offending` points at them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmill.llm.labelled import held_out, sample

#: Labelled documents to learn from, at most, and the longest of them in characters.
ROWS, MOST_CHARS = 8000, 50_000
#: Features with a weight, at most; the least number of sample documents and of standard deviations above chance.
FEATURES, LEAST_DOCS, DEVIATIONS = 20_000, 4, 4.0
#: Lengths in bytes of the beginnings of words.
BEGINNINGS = (3, 4, 5, 6, 7)
ROUNDS, RATE, DECAY = 300, 0.08, 1e-5
#: Words whose weight a worker remembers; beyond it, it starts anew.
REMEMBERED = 500_000
#: Full stop, exclamation and question mark, semicolon and line feed end a sentence; other ASCII marks part words.
_MARKS = bytes(10 if b in b".!?;\n" else 32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def sentences(text: str | None) -> list[list[bytes]]:
    """Lower-case words of each sentence that has any."""
    lines = (text or "").lower().encode().translate(_MARKS).split(b"\n")
    return [w for line in lines if (w := line.split())]


def features(word: bytes) -> list[bytes]:
    """The word, and its beginnings marked as such."""
    return [word, *(word[:n] + b"-" for n in BEGINNINGS if n < len(word))]


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float
    known: dict[bytes, float] = field(default_factory=dict)

    def weight(self, word: bytes) -> float:
        if (w := self.known.get(word)) is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            w = self.known[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return w

    def logits(self, text: str | None) -> np.ndarray:
        weight = self.weight
        return np.array([self.bias + sum(map(weight, set(s))) for s in sentences(text)])

    def score(self, text: str | None) -> float:
        """Noisy-or over the sentences; 0 for a text without any."""
        return float(-np.expm1(-np.logaddexp(0, self.logits(text)).sum()))


def screened(split: list[tuple[int, list[list[bytes]]]]) -> dict[bytes, int]:
    """Numbers of the features that toxic documents hold more often than chance would have it."""
    share = sum(y for y, _ in split) / max(len(split), 1)
    seen, toxic = Counter(), Counter()
    for y, found in split:
        here = {f for word in {w for words in found for w in words} for f in features(word)}
        seen.update(here)
        if y:
            toxic.update(here)
    above = {f: (n - seen[f] * share) / (seen[f] * share * (1 - share)) ** 0.5 for f, n in toxic.items()
             if seen[f] >= LEAST_DOCS and share < 1}
    chosen = sorted((f for f, z in above.items() if z >= DEVIATIONS), key=lambda f: (-above[f], f))[:FEATURES]
    return {f: k for k, f in enumerate(chosen)}


def fit(rows: list[tuple[int, str]]) -> Model:
    """Gradient steps (Adam) on the documents' log likelihood; both classes weigh the same.

    Without toxic rows, or without features that tell them apart, every document scores about 0; with toxic
    rows alone, about 1.
    """
    split = [(y, found) for y, text in rows if (found := sentences(text))]
    number = screened(split)
    if not number:
        return Model({}, 30.0 if split and all(y for y, _ in split) else -30.0)
    ids, starts, docs = [], [], []
    for _, found in split:
        docs.append(len(starts))
        for words in found:
            starts.append(len(ids))
            ids += [len(number), *(number[f] for w in set(words) for f in features(w) if f in number)]  # first the bias
    ids, starts, docs = np.array(ids), np.array(starts), np.array(docs)
    y = np.array([y for y, _ in split], float)
    share = y.mean()
    weigh = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    sizes, per_doc = np.diff(np.append(starts, len(ids))), np.diff(np.append(docs, len(starts)))
    w = np.zeros(len(number) + 1)
    w[-1] = -5.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        logit = np.add.reduceat(w[ids], starts)
        p = 1 / (1 + np.exp(-logit))
        none = np.exp(-np.add.reduceat(np.logaddexp(0, logit), docs))  # probability that no sentence is toxic
        pull = weigh * np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
        slope = np.bincount(ids, np.repeat(np.repeat(pull, per_doc) * p, sizes), len(w))
        slope[:-1] += DECAY * w[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model({f: float(w[k]) for f, k in number.items()}, float(w[-1]))


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, most_chars: int = MOST_CHARS) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, toxic), without the rows that are held out."""
    return fit(sample(docs, labels, "toxic", 3, 1, rows, most_chars))


def scored(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs.

    Whole texts; a null or empty one, or one of marks alone, scores 0. Repeated rows are scored one by one.
    Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array([sent.value.score(t.as_py()) for t in batch.column("text")], pa.float64())
            yield batch.drop_columns(["text"]).append_column("score", score)

    rows = docs.select(F.col("doc_id").cast("long"), held_out(3, 1).alias("held_out"), F.col("text").cast("string"))
    out = rows.mapInArrow(part, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def offending(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, sentence (number among those with words, from 0), probability, words of each offending sentence."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = sentences(text)
                p = 1 / (1 + np.exp(-sent.value.logits(text)))
                rows += [(doc_id, int(k), float(p[k]), b" ".join(found[k]).decode()) for k in np.flatnonzero(p >= least)]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.float64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sentence", "probability", "words"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(part, "doc_id long, sentence int, probability double, words string")
