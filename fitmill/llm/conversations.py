"""Conversation structure repair by the auction shortest-path algorithm.

The rows of a conversation, in order, are the layers of a lattice; a node is (rows behind it, last role kept), and
an arc is an edit with its integer cost: Delete, Insert, Keep or Rerole. A path from (0, nothing) to a legal end is a
repair. `auction` finds the prices of all nodes: from an origin it lengthens a path along arcs that are tight
(price = cost + next price) and, where no arc is, raises the price of the path's last node to the least
cost + next price and takes the node off the path. Origins come from the last layer backwards and keep the prices;
a run ends where its path meets a node whose price an earlier run has settled. At the end prices are the costs to
the end (the dual optimum), all cheapest repairs consist of tight arcs, and `traced` follows the least letter.

A conversation may be longer than a task should hold, so rows are sorted by ranges of (conversation, turn, role,
text), which cuts a hot conversation too, and each task streams its range and cuts it into blocks of at most
BLOCK_ROWS rows or BLOCK_BYTES. A block that is a whole conversation is repaired at once. Of the others each block
brings the cost between each pair of roles at its ends, and which end the least letters lead to; one small lattice of
blocks a conversation gives every block its ends, and then blocks are traced on their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmill.llm.shared import written

#: Costs of the edits, and of a truncated row that isn't deleted.
RETITLED, DELETED, INSERTED, TRUNCATED = 1, 2, 5, 5
#: Rows and bytes of text (with one row more) that a task holds of a conversation.
BLOCK_ROWS, BLOCK_BYTES = 512, 16 << 20
#: What the last row kept is: nothing yet, system, user, assistant.
STATES = range(4)
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)
_ROLES = {2: "user", 3: "assistant"}
#: Cost and edits from each state to the nearest legal end behind the last row.
_ENDS = ((0, ""), (2 * INSERTED, "II"), (INSERTED, "I"), (0, ""))
_NEVER = float("inf")
_MOST = (1 << 63) - 1


# one lattice --------------------------------------------------------------------------

def auction(arcs: list[list[tuple]], sink: int) -> list[float]:
    """Price of each node: the least cost to the sink, infinite where none leads there.

    arcs[v] holds (letter, node, cost), no cycle of cost 0; arcs lead to later nodes or within a layer.
    """
    into = [[] for _ in arcs]
    for v, some in enumerate(arcs):
        for _, w, _ in some:
            into[w].append(v)
    leads, waiting = {sink}, [sink]
    while waiting:  # nodes without a way to the sink would raise one another's prices for ever
        new = set(into[waiting.pop()]) - leads
        leads |= new
        waiting += new
    prices = [0 if v in leads else _NEVER for v in range(len(arcs))]
    settled = [v == sink or v not in leads for v in range(len(arcs))]
    for origin in range(len(arcs) - 1, -1, -1):
        if origin == sink:
            continue
        path = [origin]
        while not settled[path[-1]]:
            v, low, best = path[-1], _NEVER, -1
            for _, w, cost in arcs[v]:
                if cost + prices[w] < low:
                    low, best = cost + prices[w], w
            if prices[v] < low:  # contract
                prices[v] = low
                if len(path) > 1:
                    path.pop()
            else:  # extend
                path.append(best)
        for v in path:  # tight all along, to a settled price
            settled[v] = True
    return prices


def traced(arcs: list[list[tuple]], prices: list[float], source: int, sink: int) -> list[tuple]:
    """The tight arcs from source to sink with the least letters."""
    out, v = [], source
    while v != sink:
        arc = min(a for a in arcs[v] if a[2] + prices[a[1]] == prices[v])
        out.append(arc)
        v = arc[1]
    return out


@lru_cache(maxsize=64)
def _edits(kind: str, q: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row of this kind in state q: letter, rows passed, next state, cost.

    Kinds: s, u, a and x for other roles, in capitals where the text is truncated; - where the row must go.
    """
    out = [("D", 1, q, DELETED), ("I", 0, _NEXT[q], INSERTED)]
    if kind != "-":
        more = TRUNCATED if kind.isupper() else 0
        if (q, kind.lower()) in _AFTER:
            out.append(("K", 1, _AFTER[q, kind.lower()], more))
        out.append(("R", 1, _NEXT[q], RETITLED + more))
    return out


def _lattice(kinds: str) -> list[list[tuple]]:
    """Arcs between nodes 4 * row + state; the last layer and the sink behind it have none yet."""
    arcs = [[(letter, 4 * (k + rows) + after, cost) for letter, rows, after, cost in _edits(kind, q)]
            for k, kind in enumerate(kinds) for q in STATES]
    return arcs + [[] for _ in range(5)]


@lru_cache(maxsize=1 << 15)
def repair(kinds: str) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of a whole conversation, the least in ASCII among those."""
    arcs, last = _lattice(kinds), 4 * len(kinds)
    sink = last + 4
    for q in (0, 3):
        arcs[last + q].append(("", sink, 0))
    for q in STATES:
        arcs[last + q].append(("I", last + _NEXT[q], INSERTED))
    prices = auction(arcs, sink)
    return int(prices[0]), "".join(a[0] for a in traced(arcs, prices, 0, sink))


@lru_cache(maxsize=1 << 12)
def between(kinds: str) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """For each state before a block: (state behind it, cost, letters) as far as there is a way, by letters.

    Insertions behind the last row belong to the next block, so no letters of one are the beginning of another's.
    """
    ways, last = [[] for _ in STATES], 4 * len(kinds)
    for q in STATES:
        arcs = _lattice(kinds)
        arcs[last + q].append(("", last + 4, 0))
        prices = auction(arcs, last + 4)
        for before in STATES:
            if prices[before] < _NEVER:
                ways[before].append((q, int(prices[before]), "".join(a[0] for a in traced(arcs, prices, before, last + 4))))
    return tuple(tuple(sorted(w, key=lambda x: x[2])) for w in ways)


def applied(letters: str, roles: list[str], texts: list[str], q: int = 0) -> tuple[list[tuple[str, str]], int]:
    """(role, text) of the rows that the edits leave, and the state behind them; q is the one before."""
    out, k = [], 0
    for letter in letters:
        if letter == "I":
            q = _NEXT[q]
            out.append((_ROLES[q], ""))
            continue
        if letter == "K":
            q = _AFTER[q, roles[k][:1]]
            out.append((roles[k], texts[k]))
        elif letter == "R":
            q = _NEXT[q]
            out.append((_ROLES[q], texts[k]))
        k += 1
    return out, q


# rows in order ------------------------------------------------------------------------

_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
#: A block of rows. Sums over a conversation's blocks are its figures; `kinds` and `rows` only where not `whole`.
_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("nth", pa.int64()), ("whole", pa.bool_()), ("gaps", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("cost", pa.int64()), ("audit", pa.string()), ("messages", _MESSAGES), ("kinds", pa.string()), ("rows", _MESSAGES),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("ends", pa.string()),
    ("ways", pa.list_(pa.int64()))])
_DDL = ("conv_id long, part long, nth long, whole boolean, gaps long, blank long, duplicate long, truncated long, "
        "illegal long, cost long, audit string, messages array<struct<role:string,text:string>>, kinds string, "
        "rows array<struct<role:string,text:string>>, first_turn long, last_turn long, turns long, ends string, "
        "ways array<long>")
_LEGAL = {"su", "ua", "au"}


def _gaps(first: int | None, last: int | None, turns: int) -> int:
    return min(last - first + 1 - turns, _MOST) if turns else 0


class _Block:
    """Rows of one conversation as they come."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.kinds, self.roles, self.texts, self.size = conv_id, [], [], [], 0
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.roles and self.roles[-1][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        if fault:
            self.faults[fault] += 1
        kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
        self.kinds.append("-" if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(role) + len(text)

    def row(self, part: int, nth: int, whole: bool) -> dict:
        kinds = "".join(self.kinds)
        out = {"conv_id": self.conv_id, "part": part, "nth": nth, "whole": whole, **self.faults}
        if whole:
            cost, audit = repair(kinds)
            messages, _ = applied(audit, self.roles, self.texts)
            return out | {"gaps": _gaps(self.first, self.last, self.turns), "illegal": self.illegal, "cost": cost,
                          "audit": audit, "messages": [{"role": r, "text": t} for r, t in messages]}
        # the block's figures without those that cross its ends; ways: before, behind, cost, by letters
        ways = [x for q, some in enumerate(between(kinds)) for behind, cost, _ in some for x in (q, behind, cost)]
        return out | {"illegal": self.illegal, "kinds": kinds, "first_turn": self.first, "last_turn": self.last,
                      "rows": [{"role": r, "text": t} for r, t in zip(self.roles, self.texts)], "turns": self.turns,
                      "ends": (self.roles[0][:1] or "-") + (self.roles[-1][:1] or "-"), "ways": ways}


def _blocks(ordered: DataFrame) -> DataFrame:
    """Blocks of rows that come in the order of conversations and turns."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, nth, held, size, begun = TaskContext.get().partitionId(), 0, [], 0, False
        block, opened = None, True  # a partition's first conversation may have begun before, its last may go on

        def done(whole: bool) -> None:
            nonlocal nth, size
            held.append(block.row(number, nth, whole))
            nth, size = nth + 1, size + block.size

        def batch() -> pa.RecordBatch:
            nonlocal held, size
            out, held, size = pa.RecordBatch.from_pylist(held, _SCHEMA), [], 0
            return out

        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "first", "n"))
            for conv_id, turn, role, text, fault, first, n in zip(*columns):
                if not begun or conv_id != block.conv_id:
                    if begun:
                        done(not opened)
                        opened = False
                    block, begun = _Block(conv_id), True
                for k in range(n):
                    if len(block.roles) >= BLOCK_ROWS or block.size >= BLOCK_BYTES:
                        opened = True
                        done(False)
                        block = _Block(conv_id)
                        if size >= BLOCK_BYTES:
                            yield batch()
                    block.add(turn, role, text, fault if fault == "blank" or first and not k else "duplicate")
                if len(held) >= 1000 or size >= BLOCK_BYTES:
                    yield batch()
        if begun:
            done(False)
            yield batch()

    return ordered.mapInArrow(part, _DDL)


_COARSE = "part long, nth long, before int, behind int, gaps long, more_illegal long, tail string"


def _joined(blocks: pd.DataFrame) -> pd.DataFrame:
    """States at the ends of each block of one conversation, and the figures that cross ends, at its first block."""
    blocks = blocks.sort_values(["part", "nth"])
    ways = [[w[k:k + 3] for k in range(0, len(w), 3)] for w in (list(map(int, w)) for w in blocks["ways"])]
    last = 4 * len(ways)
    arcs = [[(place, 4 * (k + 1) + behind, cost) for place, (before, behind, cost) in enumerate(some) if before == q]
            for k, some in enumerate(ways) for q in STATES]
    arcs += [[(0, last + 4, cost)] for cost, _ in _ENDS] + [[]]
    path = [a[1] % 4 for a in traced(arcs, auction(arcs, last + 4), 0, last + 4)[:-1]]
    ends = "".join(blocks["ends"])
    illegal = sum(ends[k:k + 2] not in _LEGAL for k in range(1, len(ends) - 1, 2))
    dated = [(int(a), int(b), int(n)) for a, b, n in zip(blocks["first_turn"], blocks["last_turn"], blocks["turns"]) if n]
    turns = sum(n for _, _, n in dated) - sum(x[1] == y[0] for x, y in zip(dated, dated[1:]))
    first = [0] * (len(ways) - 1)
    return pd.DataFrame({
        "part": blocks["part"], "nth": blocks["nth"], "before": [0, *path[:-1]], "behind": path,
        "gaps": [_gaps(dated[0][0], dated[-1][1], turns) if dated else 0, *first], "more_illegal": [illegal, *first],
        "tail": [*[""] * len(first), _ENDS[path[-1]][1]]})


def _rejoined(blocks: DataFrame) -> DataFrame:
    """The blocks that are not whole conversations, repaired."""
    small = blocks.select("conv_id", "part", "nth", "ways", "ends", F.coalesce("first_turn", F.lit(0)).alias("first_turn"),
                          F.coalesce("last_turn", F.lit(0)).alias("last_turn"), "turns")
    found = written(small.groupBy("conv_id").applyInPandas(_joined, _COARSE))
    both = blocks.drop("gaps").join(found, ["part", "nth"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                (way,) = [w for w in between(row["kinds"])[row["before"]] if w[0] == row["behind"]]
                audit = way[2] + row["tail"]
                roles, texts = [m["role"] for m in row["rows"]], [m["text"] for m in row["rows"]]
                messages, _ = applied(audit, roles, texts, row["before"])
                keep = {c: row[c] for c in ("conv_id", "part", "nth", "whole", "gaps", "blank", "duplicate", "truncated")}
                out.append(keep | {"illegal": row["illegal"] + row["more_illegal"], "audit": audit,
                                   "cost": way[1] + INSERTED * len(row["tail"]),
                                   "messages": [{"role": r, "text": t} for r, t in messages]})
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    return both.mapInArrow(part, _DDL)


def _fault(text: Column) -> Column:
    """blank or truncated, else null."""
    final = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(final == "", "blank").when(~final.rlike(r"[.!?]"), "truncated")


def repaired(conversations: DataFrame) -> DataFrame:
    """Repaired blocks of conversations(conv_id, turn, role, text): conv_id, part, nth, whole, gaps, blank,
    duplicate, truncated, illegal, cost, audit, messages.

    A conversation's rows go by turn, null first, then role and text. Its blocks go by part and nth: figures add
    up over them, audit and messages(role, text) follow one another. `whole` blocks are alone. Null roles and
    texts are one space (so such a text is blank, such a role neither kept nor legal); a null conv_id is a
    conversation; rows that repeat role and text are duplicates, however often. gaps above 2^63 - 1 are that.
    An empty table gives none. Other columns are not read.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.withColumn("said", F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
    # equal rows are one with a number, so no key is hot: turns part what one conversation repeats
    once = rows.groupBy("conv_id", "turn", "said").agg(F.min("role").alias("role"), F.min("text").alias("text"), F.count(F.lit(1)).alias("n"))
    first = (rows.groupBy("conv_id", "said").agg(F.min("turn").alias("low"), F.max(F.col("turn").isNull()).alias("undated"))
             .select(F.col("conv_id").alias("c"), F.when(~F.col("undated"), F.col("low")).alias("t"), F.col("said").alias("s"), F.lit(True).alias("first")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("said") == F.col("s"))
    marked = once.join(first.hint("merge"), same, "left").select(
        "conv_id", "turn", "role", "text", _fault(F.col("text")).alias("fault"), F.coalesce("first", F.lit(False)).alias("first"), "n")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    blocks = written(_blocks(marked.repartitionByRange(*order).sortWithinPartitions(*order)))
    columns = ["conv_id", "part", "nth", "whole", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "messages"]
    return blocks.where("whole").select(columns).unionByName(_rejoined(blocks.where("NOT whole")).select(columns))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults, by crc32('conv_id:turn') modulo 20; nulls in the three are one space.

    0 drops the row, 1 empties its text, 2 removes its . ! ?, 3 repeats it, 4 makes its role user.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("kind", F.crc32(name.cast("binary")) % 20).where("kind <> 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(conversations: DataFrame, blocks: DataFrame) -> DataFrame:
    """A row per conv_id of `conversations`: the sums over its repaired blocks, audit, and repaired_sha256 of its
    rows as role:text lines. A conversation without blocks has zeros, no audit and the hash of nothing.

    A task streams the blocks of its conversations in their order and holds a batch of them and one audit.
    """
    none = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("nth"),
        *[F.lit(0).cast("long").alias(c) for c in _SUMS], F.lit("").alias("audit"), F.expr("cast(null AS array<struct<role:string,text:string>>)").alias("messages"))
    rows = blocks.select(none.columns).unionByName(none).repartition("conv_id")
    names = ["conv_id", *_SUMS, "audit", "repaired_sha256"]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, state = [], None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 7 else pa.string()) for k, c in enumerate(zip(*out))], names)

        def close() -> None:
            out.append((state[0], *state[1], "".join(state[2]), state[3].hexdigest()))

        for some in batches:
            ids, audits, messages = (some.column(c) for c in ("conv_id", "audit", "messages"))
            sums = list(zip(*(some.column(c).to_pylist() for c in _SUMS)))
            for k, conv_id in enumerate(ids.to_pylist()):
                if state is None or state[0] != conv_id:
                    if state:
                        close()
                    state = [conv_id, (0,) * len(_SUMS), [], sha256(), False]
                state[1] = tuple(x + y for x, y in zip(state[1], sums[k]))
                state[2].append(audits[k].as_py())
                for m in messages[k].as_py() or ():
                    state[3].update(f"{chr(10) if state[4] else ''}{m['role']}:{m['text']}".encode())
                    state[4] = True
            if len(out) >= 10_000:
                yield batch()
                out = []
        if state:
            close()
            yield batch()

    kinds = ", ".join(f"{c} {'long' if k < 7 else 'string'}" for k, c in enumerate(names))
    return rows.sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "nth").mapInArrow(part, kinds)
