"""Substring deduplication of words by suffix automata: what 20 words in a row repeat is removed.

The corpus itself is the reference. Its stretches that may hold repeats are dealt to shards (the buckets of
`repeats`) by a hash that equal windows share, so that a document meets the one shard that can hold its matches
instead of every shard's automaton being sent to all tasks: the reference grows with the corpus, and broadcasting
it would too. In a shard the stretches are streamed through a generalised suffix automaton in corpus order, which
gives after every word the length of the longest match that began earlier, and takes the word in. Where that
length reaches 20 a window is a repeat; the words of all of a document's repeated windows, its maximal spans,
are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fitmill.llm.automaton import Automaton
from fitmill.llm.repeats import Hashes, Kind, covered, mixed, repeats, with_repeats

LENGTH, PIECE = 20, 6
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words of a text in UTF-8."""
    edges = np.diff(~_SPACE[np.frombuffer(data, np.uint8)], prepend=False, append=False)
    at = np.flatnonzero(edges)
    return at[::2], at[1::2]


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for each word of texts in a row, and the number of words up to the end of each text."""
    data = b" ".join(texts)
    begin, end = spans(data)
    bytes_ = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    numbers = mixed(Hashes(bytes_).of(begin, end)) if len(begin) else np.empty(0, np.uint64)
    return numbers, np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))


def content(data: bytes, ranges: list[tuple[int, int]]) -> list[bytes]:
    """The words of each range, a space between them."""
    begin, end = spans(data)
    return [b" ".join(data[b:e].split()) for b, e in ((begin[f], end[t - 1]) for f, t in ranges)]


def repeated_windows(contents: list[bytes], groups: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For contents in corpus order: a mask of the windows of each that occur at an earlier window, of any group."""
    automaton, number, masks = Automaton(), {}, []
    for words in map(bytes.split, contents):
        earlier = automaton.add([number.setdefault(w, len(number)) for w in words])
        masks.append(np.array(earlier[length - 1:]) >= length)
    return masks


def _digests(data: bytes, places: np.ndarray) -> list[bytes]:
    words = data.split()
    return [hashlib.md5(b" ".join(words[k:k + LENGTH])).digest() for k in places.tolist()]


KIND = Kind(LENGTH, PIECE, symbols, content, repeated_windows, _digests)


def deduplicated(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of docs, and on demand `kept`, the words left.

    A null text has no words. Rows with the same doc_id and text are one document; rows with the same doc_id
    and different texts come in the order of a hash of the text; a null doc_id is the smallest. Other columns
    are not read.
    """
    found = with_repeats(docs, repeats(docs, KIND))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places, counts in zip(batch.column("text"), batch.column("places"), batch.column("counts")):
                words = (text.as_py() or "").encode().split()
                mask = covered(len(words), LENGTH, places.as_py(), counts.as_py())
                kept = b" ".join([w for w, m in zip(words, mask.tolist()) if not m] if mask.any() else words)
                rows.append((len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds))], names)

    out = found.mapInArrow(part, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out if with_text else out.drop("kept")
