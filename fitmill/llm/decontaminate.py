"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' words become numbers and every item is fed to one automaton, each from the root. A document's words
are streamed through it: after each word the state and length say what longest piece of an item ends there, and
the states on the way up its suffix links say which windows (of `window` words, or a whole shorter item) end
there, and in which items. Words inside windows are hits; `cleaned` cuts them out, or drops a document whose
hits pass a share of its words.

Most words of most documents can't be in a window: a window is a run of word pairs that are neighbours in some
item. Pairs are looked up in one sorted array for a whole document, and only long enough runs are streamed.

Items of more than MOST_WORDS words are cut into shards, each with an automaton and a pass over the documents of its
own; hit spans and item ids are united by document before they are counted. A long item is cut into pieces that
overlap by all but one word of a window, so that each of its windows is in a piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmill.llm.automaton import Automaton
from fitmill.llm.shared import small_batches, text_key, written

WINDOW = 10
#: Words of all items together that one automaton may hold (some 300 bytes each in every worker).
MOST_WORDS = 2_000_000
#: Words of a piece of an item.
PIECE = 1 << 16
#: Bytes that separate words: 00-2F, 3A-60 and 7B-7F, after A-Z have become a-z.
_SPACES = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of a text; bytes.lower() changes A-Z alone."""
    return (text or "").encode().lower().translate(_SPACES).split()


class Items:
    """The test items as an automaton, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.window, self.number, self.automaton = window, {}, Automaton()
        sequences = []
        for item_id, text in items:
            if sequence := [self.number.setdefault(w, len(self.number)) for w in words(text)]:
                sequences.append((item_id, sequence))
                self.automaton.add(sequence)
        self.least = min([window, *(len(s) for _, s in sequences)])
        self.pairs = np.unique([a << 32 | b for _, s in sequences for a, b in zip(s, s[1:])] or [-1])
        # ends[state]: lengths of windows that are words of this state, with their items
        self.ends: dict[int, dict[int, set[str]]] = {}
        for item_id, sequence in sequences:
            size, state, length = min(window, len(sequence)), 0, 0
            for k, symbol in enumerate(sequence):
                state, length = self.automaton.step(state, length, symbol)
                if k + 1 >= size:
                    self.ends.setdefault(self._at(state, size), {}).setdefault(size, set()).add(item_id)

    def _at(self, state: int, size: int) -> int:
        """The state that holds the suffix of this size of the state's words."""
        while self.automaton.length[self.automaton.link[state]] >= size:
            state = self.automaton.link[state]
        return state

    def hits(self, text: str | None) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, a mask of those in windows, and the items whose windows occur."""
        found = words(text)
        ids = np.fromiter(map(self.number.get, found, [-1] * len(found)), np.int64, len(found))
        mask, items = np.zeros(len(found), bool), set()
        for begin, end in self._runs(ids):
            state = length = 0
            for k in range(begin, end):
                state, length = self.automaton.step(state, length, int(ids[k]))
                at = state
                while at > 0:
                    for size, names in self.ends.get(at, {}).items():
                        if size <= length:
                            mask[k + 1 - size:k + 1] = True
                            items |= names
                    at = self.automaton.link[at]
        return len(found), mask, items

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of words that could hold a window: known words whose neighbours are neighbours in items."""
        known = np.flatnonzero(ids >= 0)
        if self.least == 1:
            cut = np.flatnonzero(np.diff(known) > 1) + 1
            yield from ((int(r[0]), int(r[-1]) + 1) for r in np.split(known, cut) if len(r))
            return
        if len(known) < self.least:
            return
        pair = np.zeros(len(ids) + 1, bool)  # pair[k]: words k - 1 and k
        second = known[1:][np.diff(known) == 1]
        keys = ids[second - 1] << 32 | ids[second]
        place = np.searchsorted(self.pairs, keys)
        pair[second] = self.pairs[np.minimum(place, len(self.pairs) - 1)] == keys
        edges = np.flatnonzero(np.diff(pair.astype(np.int8), prepend=0))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin + 1 >= self.least:
                yield begin - 1, end


def _named(benchmark: DataFrame) -> DataFrame:
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    return benchmark.select(name.alias("item_id"), F.col("text").cast("string").alias("text"))


def collect_items(benchmark: DataFrame) -> list[tuple[str, str | None]]:
    """All test items, for one automaton; more than MOST_WORDS raise an error before they come to the driver."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1
    if (benchmark.agg(F.sum(size)).first()[0] or 0) > MOST_WORDS:
        raise ValueError(f"the items may have more than {MOST_WORDS} words; cut them by shards()")
    return [tuple(r) for r in _named(benchmark).collect()]


def shards(benchmark: DataFrame, window: int = WINDOW) -> Iterator[list[tuple[str, str]]]:
    """The test items in lists of at most MOST_WORDS words (or one piece); the driver holds one list at a time."""
    longest = max(PIECE, window)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, sizes = [], [], []
            for name, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                found, end = words(text), window - 1
                while found and (end < len(found) or end == window - 1):
                    piece = found[end - window + 1:end - window + 1 + longest]
                    end += longest - window + 1
                    names.append(name)
                    texts.append(b" ".join(piece).decode())
                    sizes.append(len(piece))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                                             ["item_id", "text", "n"])

    some, total = [], 0
    for row in _named(benchmark).mapInArrow(part, "item_id string, text string, n long").toLocalIterator():
        if some and total + row["n"] > MOST_WORDS:
            yield some
            some, total = [], 0
        some.append((row["item_id"], row["text"]))
        total += row["n"]
    if some:
        yield some


_FOUND = "doc_id long, text_key long, n_words long, spans array<struct<begin:int,end:int>>, names array<string>"


def _spans(docs: DataFrame, items: Broadcast, window: int, all_rows: bool) -> DataFrame:
    """n_words, hit spans and item ids of the rows, or of those with hits only."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = Items(items.value, window)
        for batch in batches:
            keep, sizes, spans, names = [], [], [], []
            for text in batch.column("text"):
                n, mask, found = built.hits(text.as_py())
                edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()
                keep.append(all_rows or bool(edges))
                sizes.append(n)
                spans.append([{"begin": b, "end": e} for b, e in zip(edges[::2], edges[1::2])])
                names.append(sorted(found))
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(spans, kind),
                 pa.array(names, pa.list_(pa.string()))], ["doc_id", "text_key", "n_words", "spans", "names"]
            ).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(part, _FOUND)


def _united(docs: DataFrame, lists: Iterator[list[tuple[str, str]]], window: int) -> DataFrame:
    """doc_id, text_key, spans (they may overlap) and sorted names of documents with hits, a pass for each list."""
    out = None
    for items in lists:
        sent = docs.sparkSession.sparkContext.broadcast(items)
        found = written(_spans(docs, sent, window, False))
        sent.unpersist()
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "text_key").agg(
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text").cast("string")).alias("text_key"), F.col("text").cast("string").alias("text"))


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_key") == F.col(f"{right}.text_key"))


def _first_two(benchmark: DataFrame, window: int) -> tuple[list, list | None, Iterator]:
    """The first list of items, the second or None, and all lists."""
    small_batches(benchmark.sparkSession)
    lists = shards(benchmark, window)
    first, second = next(lists, []), next(lists, None)
    return first, second, chain([first], [] if second is None else [second], lists)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per row of docs(doc_id, text): doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated.

    benchmark(item_id, text): items without words and null texts have no windows; a null item_id is called
    "null"; items that share an id count as one; without items nothing is hit. A null or empty document has
    no words. Rows that repeat are answered one by one. Other columns are not read.
    """
    rows = _keyed(docs)
    first, second, lists = _first_two(benchmark, window)
    if second is None:
        found = _spans(rows, docs.sparkSession.sparkContext.broadcast(first), window, True)
    else:
        none = docs.sparkSession.sparkContext.broadcast([])
        counted = _spans(rows, none, window, True).select("doc_id", "text_key", "n_words")
        found = (counted.alias("d").join(_united(rows, lists, window).alias("h"), _same("d", "h"), "left")
                 .select("d.*", F.coalesce("h.spans", F.array()).alias("spans"), F.coalesce("h.names", F.array()).alias("names")))
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["begin"], s["end"] - 1)))
    return found.select(
        "doc_id", "text_key", "n_words", F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
        F.size("names").cast("long").alias("n_items"), F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_share: float = 0.5) -> DataFrame:
    """docs without contamination, in its own columns: hit words are cut out with the bytes up to the next word.

    A document of which more than `most_share` of the words are hit is dropped. n_chars, where there is such a
    column, is that of the new text. Texts without hits stay as they are, null and empty ones too.
    """
    first, second, lists = _first_two(benchmark, window)
    items, given, extra = None, docs, None
    if second is None:
        items = docs.sparkSession.sparkContext.broadcast(first)
    else:
        extra = "spans" + "_" * max(map(len, docs.columns))
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                           F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text").cast("string")).alias("text_key"))
        hits = _united(_keyed(docs), lists, window)
        given = rows.alias("d").join(hits.alias("h"), _same("d", "h"), "left").select("d.row.*", F.col("h.spans").alias(extra))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = Items(items.value, window) if items else None
        for batch in batches:
            keep, texts = [], []
            found = None if built else batch.column(extra).to_pylist()
            for k, text in enumerate(batch.column("text").to_pylist()):
                if built:
                    n, mask, _ = built.hits(text)
                else:
                    n = len(words(text)) if found[k] else 0
                    mask = np.zeros(n, bool)
                    for span in found[k] or []:
                        mask[span["begin"]:span["end"]] = True
                keep.append(not n or mask.sum() <= most_share * n)
                texts.append(without(text, mask) if mask.any() else text)
            at = batch.schema.get_field_index("text")
            new = batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))
            if extra:
                new = new.drop_columns([extra])
            yield new.filter(pa.array(keep, pa.bool_()))

    out = given.mapInArrow(part, docs.schema)
    if "n_chars" in docs.columns:
        changed: Column = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out


def without(text: str, mask: np.ndarray) -> str:
    """The text without the words of the mask, each cut with what stands between it and the next word."""
    data = text.encode()
    bytes_ = np.frombuffer(data.lower().translate(_SPACES), np.uint8)
    inside = np.concatenate(([False], bytes_ != 32, [False]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.append(starts[1:], len(data))
    kept, place = [], 0
    for k in np.flatnonzero(mask):
        kept.append(data[place:starts[k]])
        place = int(ends[k])
    return b"".join([*kept, data[place:]]).decode()
