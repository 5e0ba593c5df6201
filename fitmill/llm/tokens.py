"""Token ids in binary files of patched frame-of-reference blocks.

A file holds blocks of `BLOCK` ids. Of each block the minimum is subtracted; the rest is packed at the width
that `PERCENTILE` of its values need, and the values that need more are stored beside it as exceptions.
Layout, little-endian: MAGIC; the blocks (u32 count, u32 minimum, u16 exceptions, u8 width, packed bits,
u16 places and u32 values of the exceptions); u64 offset of each block; the documents (i64 id, u8 1 if the
id is null, u32 ids of it); u64 blocks, u64 documents, u64 place of the offsets.

Documents are dealt to files by ranges of doc_id, so a file is what one task sorts and writes. A task writes
under a name of its own attempt, and only the names that finished tasks report are read: a lost executor
costs a repeated task, nothing else.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitmill.llm.shared import filesystem, small_batches, text_key, workspace, written

MAGIC = b"PFOR\x01\0\0\0"
BLOCK = 4096
PERCENTILE = 95
#: Pieces and words that a worker keeps before it sets them aside and forgets those that it had set aside before.
REMEMBERED = 400_000
#: Characters of a piece or word that is kept, at most.
LONGEST = 64
#: Characters of texts that are encoded together, at most; a longer text is encoded alone.
TOGETHER = 4_000_000
#: Pieces that go to the tokenizer's model in one string, and least number of new ones for which that is done.
JOINED, FEW = 256, 16
#: Bytes that UTF-8 never has.
_NEVER = (0xC0, 0xC1, *range(0xF5, 0x100))
#: Runs of white space of which more than the last character is one piece, and that piece.
_RUN = re.compile(r"[ \n]{2,}+\Z|[ \n]{2,}(?=[ \n])")
_TWO = ("  ", " \n", "\n ", "\n\n")
#: The tokenizer's pieces of words of these characters, in which its Unicode tables and Python's can't differ.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-/:-@\[-`{-~"
_PIECE = re.compile(rf"\n|'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+")
_WORD = re.compile(rf"\n?[{_LETTERS}0-9{_MARKS}]+")
_WORDS = re.compile(rf"(?:[ \n][{_LETTERS}0-9{_MARKS}]++)*+")
_SPACE = re.compile(r"\s")


# ids of texts ------------------------------------------------------------------------

class _Odd(Exception):
    """A word that may not be encoded apart from its text."""


class _Words(dict):
    """Ids as little-endian u32 of pieces, of runs, and of other words, all but those at a line feed with the space before them."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        self.encode, self.before = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encode(word)
        self.keep(word, ids)
        return ids

    def keep(self, word: str, ids: bytes) -> None:
        if len(word) > LONGEST:
            return
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[word] = ids


class Encoder:
    """Gives the ids of texts as little-endian u32, just as the tokenizer gives them for each whole text.

    Byte-level BPE works within pieces, and no piece spans the end of a word before a space or line feed, but
    for runs of three, or two at the end of a text. So texts are cut there, and runs are encoded as they are.
    Arrow finds the different words, with the one space or line feed before them, of many texts; those of usual
    characters are cut into pieces here, and these are looked up. New ones go to the tokenizer's
    model in one string, with a letter between them that stands for a byte that UTF-8 never has and is in no
    token but its own, so that nothing merges with it. Words of other characters go through the whole tokenizer.
    Texts with white space of other kinds, or with what may be a special token's string, are encoded as they
    are, and with a tokenizer of another kind all texts are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.known = Tokenizer.from_file(path), _Words(self._word)
        model, line = self.tokenizer.model, self._plain("\n")
        self.cut = model.tokenize
        same = ByteLevel(add_prefix_space=False, use_regex=True).__getstate__()
        split, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        self.by_word = (len(line) == 4 and self.tokenizer.normalizer is None and type(model).__name__ == "BPE"
                        and split is not None and split.__getstate__() == same and self.tokenizer.post_processor is None
                        and self.tokenizer.truncation is None and self.tokenizer.padding is None
                        and not (model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix or model.ignore_merges)
                        and all(t.content.startswith("<|") and _SPACE.search(t.content) is None and not t.lstrip for t in added))
        if not self.by_word:
            return
        # the letters that stand for the bytes of characters
        self.letters = {c: split.pre_tokenize_str(chr(c))[0][0] for c in (0x0A, *range(0x20, 0x7F), *range(0xA1, 0x100))}
        # the letter between pieces; what merges make are tokens, so a letter that one token has is in no merge
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        tokens = "".join(vocabulary)
        self.letters[0] = next((c for c in map(chr, _NEVER) if c in vocabulary and tokens.count(c) == 1), None)
        self.between, self.by_word = vocabulary.get(self.letters[0]), self.letters[0] is not None

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word in ("", "\n"):
            return self._new([word or " "])[0].tobytes()
        if not word.strip(" \n"):
            return self._plain(word)
        line = word[0] == "\n"
        if "<|" in word or _SPACE.search(word, line):
            raise _Odd
        return self.known["\n"] + self._plain(word[1:]) if line else self._plain(" " + word)

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, and how many each has."""
        found, joined = [], JOINED if len(pieces) >= FEW else 1
        for k in range(0, len(pieces), joined):
            found += [t.id for t in self.cut("\0".join(pieces[k:k + joined]).translate(self.letters))]
            found.append(self.between)
        ids = np.array(found, "<u4")
        ends = np.flatnonzero(ids == self.between)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        known, before = self.known, self.known.before
        found = list(map(known.get, pieces))
        lacking = [k for k, ids in enumerate(found) if ids is None]
        if lacking:
            kept = {p: before.get(p) for p in map(pieces.__getitem__, lacking)}
            new = [p for p, ids in kept.items() if ids is None]
            ids, size = self._new(new)
            data, start = ids.tobytes(), 0
            for piece, end in zip(new, (4 * np.cumsum(size)).tolist(), strict=True):
                kept[piece] = data[start:end]
                start = end
            for piece, ids in kept.items():
                known.keep(piece, ids)
            for k in lacking:
                found[k] = kept[pieces[k]]
        return found

    def _different(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The ids of different words, how many each has, and the places of those that may not be encoded apart."""
        whole, usual, rest, odd = " ".join(["", *words[1:]]).replace(" \n", "\n"), range(1, len(words)), [0], []
        if "<|" in whole or not _WORDS.fullmatch(whole):
            usual, rest = [], [0]
            for k in range(1, len(words)):
                (usual if _WORD.fullmatch(words[k]) and "<|" not in words[k] else rest).append(k)
            whole = " ".join(["", *map(words.__getitem__, usual)]).replace(" \n", "\n")
        found = [b""] * len(rest)
        for n, k in enumerate(rest):
            try:
                found[n] = self.known[words[k]]
            except _Odd:
                odd.append(k)
        ids, size = _flat(found)
        pieces = _PIECE.findall(whole)
        if pieces:
            more, each = _flat(self._pieces(pieces))
            size = np.concatenate([size, np.add.reduceat(each, np.flatnonzero([p[0] in " \n" for p in pieces]))])
            ids = np.concatenate([ids, more])
        place = np.empty(len(words), np.int64)
        place[[*rest, *usual]] = np.arange(len(words))
        return *_gathered(ids, size, place), odd

    def _together(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the first of the different words is the empty one before the first white space."""
        parts, runs, last = [], [], []  # the runs stand behind the parts
        for text in texts:
            place = 0
            for run in _RUN.finditer(text) if any(two in text for two in _TWO) else ():
                parts.append(text[place:run.start()])
                runs.append(self.known[run[0]])
                place = run.end()
            parts.append(text[place:])
            runs.append(b"")
            last.append(len(parts))
        bare = [t[:1] not in ("", " ", "\n") for t in parts]
        lines = pa.array(["\n" + t if b else t for t, b in zip(parts, bare)], pa.large_string())
        words = pc.split_pattern(pc.replace_substring(lines, "\n", " \n"), " ")
        coded, bounds = words.flatten().dictionary_encode(), words.offsets.to_numpy()
        nth = coded.indices.to_numpy()
        ids, size, odd = self._different(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, n = _gathered(ids, size, nth, bounds[:-1])  # nothing before the white space that each part begins with now
        data, ends = ids.tobytes(), 4 * np.concatenate([[0], np.cumsum(n)])[bounds]
        found = [data[a:b] + run for a, b, run in zip((ends[:-1] + np.multiply(4, bare)).tolist(), ends[1:].tolist(), runs)]
        out = found if len(parts) == len(texts) else [b"".join(found[a:b]) for a, b in zip([0, *last], last)]
        if odd:
            at = np.searchsorted(bounds, np.flatnonzero(np.isin(nth, odd)), "right") - 1
            for k in np.unique(np.searchsorted(last, at, "right")).tolist():
                out[k] = self._plain(texts[k])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return [self._plain(t) for t in texts]
        out, start, chars = [], 0, 0
        for k, text in enumerate(texts):
            if chars and chars + len(text) > TOGETHER:
                out += self._together(texts[start:k])
                start, chars = k, 0
            chars += len(text)
        return out + self._together(texts[start:]) if texts else out


def _flat(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4


def _gathered(ids: np.ndarray, size: np.ndarray, nth: np.ndarray, none: np.ndarray = ()) -> tuple[np.ndarray, np.ndarray]:
    """Of lists that stand one behind the other, those at nth, and their sizes; those at `none` of nth are left empty."""
    n = size.astype(np.int32)[nth]
    n[np.asarray(none, np.int64)] = 0
    ends = np.cumsum(n, dtype=np.int32)
    first = (np.cumsum(size) - size).astype(np.int32)[nth] - ends + n
    return ids[np.repeat(first, n) + np.arange(n.sum(), dtype=np.int32)], n


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# blocks ------------------------------------------------------------------------------

def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    rest = ids - np.uint32(low)
    nth = (len(rest) - 1) * PERCENTILE // 100 + ((len(rest) - 1) * PERCENTILE % 100 > 0)
    width = int(np.partition(rest, nth)[nth]).bit_length()
    places = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return b"".join((struct.pack("<IIHB", len(ids), low, len(places), width), np.packbits(bits).tobytes(),
                     places.astype("<u2").tobytes(), rest[places].astype("<u4").tobytes()))


def unpack_block(data: bytes) -> np.ndarray:
    n, low, odd, width = struct.unpack_from("<IIHB", data)
    end = 11 + (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data[11:end], np.uint8), count=n * width).reshape(n, width)
    ids = bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32)) if width else np.zeros(n, np.uint32)
    places = np.frombuffer(data[end:end + 2 * odd], "<u2")
    ids[places] = np.frombuffer(data[end + 2 * odd:end + 6 * odd], "<u4")
    return ids + np.uint32(low)


class Writer:
    """Writes one file from documents that come in order; holds one block and the list of documents."""

    def __init__(self, out) -> None:
        self.out, self.place, self.held, self.offsets = out, len(MAGIC), [], []
        self.kept, self.ids, self.nulls, self.lengths = 0, [], [], []
        out.write(MAGIC)

    def _block(self, ids: np.ndarray) -> None:
        data = pack_block(ids)
        self.offsets.append(self.place)
        self.place += len(data)
        self.out.write(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids) // 4)
        self.held.append(ids)
        self.kept += len(ids) // 4
        if self.kept >= BLOCK:
            ids = np.frombuffer(b"".join(self.held), "<u4")
            full = len(ids) // BLOCK * BLOCK
            for k in range(0, full, BLOCK):
                self._block(ids[k:k + BLOCK])
            self.held, self.kept = [ids[full:].tobytes()], len(ids) - full

    def close(self) -> int:
        if self.kept:
            self._block(np.frombuffer(b"".join(self.held), "<u4"))
        for values, kind in ((self.offsets, "<u8"), (self.ids, "<i8"), (self.nulls, "u1"), (self.lengths, "<u4")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(struct.pack("<QQQ", len(self.offsets), len(self.ids), self.place))
        return sum(self.lengths)


def read_file(file) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each document of an open file; holds a block and a document."""
    size = file.size()
    blocks, docs, place = struct.unpack("<QQQ", file.read_at(24, size - 24))
    tail = file.read_at(size - 24 - place, place)
    offsets = [*np.frombuffer(tail, "<u8", blocks).tolist(), place]
    ids = np.frombuffer(tail, "<i8", docs, 8 * blocks)
    nulls = np.frombuffer(tail, "u1", docs, 8 * (blocks + docs))
    lengths = np.frombuffer(tail, "<u4", docs, 8 * blocks + 9 * docs)
    held, nth = np.empty(0, np.uint32), 0
    for doc_id, null, n in zip(ids.tolist(), nulls.tolist(), lengths.tolist()):
        parts, have = [held], len(held)
        while have < n:
            parts.append(unpack_block(file.read_at(offsets[nth + 1] - offsets[nth], offsets[nth])))
            have += len(parts[-1])
            nth += 1
        held = np.concatenate(parts) if len(parts) > 1 else held
        yield None if null else doc_id, held[:n]
        held = held[n:]


# jobs --------------------------------------------------------------------------------

def write(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Writes docs(doc_id, text) in ascending doc_id (null first; equal ids by text key); returns its list of files.

    part, path, n_docs, n_ids; a null text is empty and gets the end id alone; no rows, no files. Other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    folder = workspace(docs.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, end, writer = TaskContext.get(), np.array([end_id], "<u4").tobytes(), None
        number = context.partitionId()
        for batch in batches:
            if writer is None and batch.num_rows:
                system, root = filesystem(folder)
                system.create_dir(root, recursive=True)
                path = f"{root}/part-{number:06d}-{context.taskAttemptId()}.pfor"
                writer = Writer(out := system.open_output_stream(path))
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer_path).encode(texts)):
                writer.add(doc_id, ids + end)
        if writer is not None:
            n_docs, n_ids = len(writer.ids), writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [number], "path": [path.rsplit("/", 1)[1]],
                                              "n_docs": [n_docs], "n_ids": [n_ids]})

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key().alias("_key"))
               .repartitionByRange("doc_id", "_key").sortWithinPartitions("doc_id", "_key").drop("_key"))
    files = written(ordered.mapInArrow(part, "part long, path string, n_docs long, n_ids long"))
    return files.withColumn("path", F.concat(F.lit(folder + "/"), "path"))


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the files that write() lists."""
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    based = files.select("part", "path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base"))

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "start", "n_tokens", "ids_crc32")
        for batch in batches:
            for row in batch.to_pylist():
                system, path = filesystem(row["path"])
                start, rows = row["base"], []
                with system.open_input_file(path) as file:
                    for doc_id, ids in read_file(file):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    spread = based.repartition(_tasks(files.sparkSession), "part")
    return spread.mapInArrow(docs, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
