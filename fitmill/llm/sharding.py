"""Sharding by best-fit-decreasing bin packing of groups that stay together.

Rows with equal texts are a group. Groups by falling size enter the bin whose remaining capacity is the tightest that
holds them; a balanced tree (a treap) keeps the bins by remaining capacity. `pack` opens bins of a fixed capacity as
it needs them. For a fixed number of shards `level` finds the least capacity that so many bins suffice for; groups
above an equal share have a shard of their own, and the others share what is left.

The packing sees at most 2 * FINENESS items a shard at any scale: groups of at least a FINENESS-th of a shard are
items of their own, of which there can't be more, and smaller groups are dealt by hash to FINENESS cells a shard,
which are items as a whole. Only sizes are shuffled for that; the items' shards are small enough to be broadcast.
Rows then go to files by ranges of (shard, doc_id), so a shard that holds a third of all rows is many tasks.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitmill.llm.shared import text_key, workspace, written

#: Items that a shard is at least dealt in where its groups are small.
FINENESS = 256


# bins --------------------------------------------------------------------------------

class Tree:
    """A treap of keys: the least key that isn't below a bound is found and taken in logarithmic time."""

    def __init__(self, seed: int = 7) -> None:
        self.root, self.draw = None, random.Random(seed).random

    def _split(self, node, key):
        """Nodes below the key, and the others. A node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] < high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high

    def add(self, key: tuple) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self.draw(), None, None]), high)

    def take(self, bound: tuple) -> tuple | None:
        """Removes and returns the least key that isn't below the bound."""
        low, high = self._split(self.root, bound)
        if high is None:
            self.root = low
            return None
        parent, node = None, high
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            high = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(low, high)
        return node[0]


def pack(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item; sizes fall, none is above the capacity. None if more than `most` bins were needed."""
    tree, bins, out = Tree(), 0, []
    for size in sizes:
        found = tree.take((size, -1))
        if found is None:
            if bins == most:
                return None
            found, bins = (capacity, bins), bins + 1
        out.append(found[1])
        tree.add((found[0] - size, found[1]))
    return out


def level(sizes: list[int], n: int) -> list[int]:
    """The shard of each item, with n shards as near to equal as best fit makes them; sizes fall."""
    own, left = 0, sum(sizes)
    while own < min(n - 1, len(sizes)) and sizes[own] * (n - own) > left:
        left, own = left - sizes[own], own + 1
    rest, bins = sizes[own:], n - own
    if not rest:
        return list(range(own))
    low = max(rest[0], -(-left // bins))
    high, best = 2 * low, None
    while best is None or low < high:  # bins of twice an equal share hold every item
        middle = (low + high) // 2 if best else high
        found = pack(rest, middle, bins)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return [*range(own), *(own + b for b in best)]


# jobs --------------------------------------------------------------------------------

def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), text_key(text).alias("group"))


def shards_of_items(docs: DataFrame, n: int) -> DataFrame:
    """own, item, shard, written: `item` is a group's key where `own`, else the cell of keys modulo n * FINENESS."""
    groups = _sized(docs).groupBy("group").agg(F.sum("size").alias("size"))
    groups = written(groups)
    total = groups.agg(F.sum("size")).first()[0] or 0
    cells = n * FINENESS
    own = F.col("size") >= F.lit(total / cells)
    items = (groups.select(own.alias("own"), F.when(own, F.col("group")).otherwise(F.pmod("group", F.lit(cells))).alias("item"), "size")
             .groupBy("own", "item").agg(F.sum("size").alias("size")))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]  # at most 2 * cells rows
        if rows:
            rows = pd.concat(rows).sort_values(["size", "own", "item"], ascending=[False, True, True])
            yield rows.assign(shard=level(rows["size"].tolist(), n))[["own", "item", "shard"]]

    return written(items.coalesce(1).mapInPandas(packed, "own boolean, item long, shard int"))


def sharded(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text, size, shard of each row of docs(doc_id, text), read from files in folders `shard=k`.

    size is the text's UTF-8 bytes and one. Rows with equal texts share a shard, and so do null and empty texts;
    a null stays null. Repeated rows and ids are all kept. An empty table gives no rows; fewer groups than shards
    leave shards empty. A group above an equal share makes its shard larger than the others. Columns `part`,
    `group` and `salt` are the files' own; other columns of the input are not read.
    """
    if n < 1:
        raise ValueError("at least one shard")
    shards = shards_of_items(docs, n)
    own = F.broadcast(shards.where("own").select(F.col("item").alias("group"), F.col("shard").alias("own_shard")))
    cells = F.broadcast(shards.where("NOT own").select(F.col("item").alias("cell"), F.col("shard").alias("cell_shard")))
    rows = _sized(docs).withColumn("cell", F.pmod("group", F.lit(n * FINENESS)))
    placed = (rows.join(own, "group", "left").join(cells, "cell", "left")
              .withColumn("shard", F.coalesce("own_shard", "cell_shard")).withColumn("salt", F.monotonically_increasing_id())
              .select("doc_id", "text", "size", "group", "salt", "shard"))
    ranged = placed.repartitionByRange("shard", "doc_id", "group", "salt").withColumn("part", F.spark_partition_id())
    path = workspace(docs.sparkSession)
    ranged.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(ranged.schema).parquet(path)


def numbered(shards: DataFrame) -> DataFrame:
    """The rows of sharded() with their place in the shard by doc_id (null first) and text: `slot`, from 0.

    Ranges of rows are numbered on their own, after the rows of the shard's earlier ranges. `text` itself isn't
    needed: where the caller drops it, only keys pass the exchange.
    """
    counts = shards.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = W.partitionBy("part", "shard").orderBy(F.asc_nulls_first("doc_id"), "group", "salt")
    placed = shards.withColumn("nth", F.row_number().over(within))
    return (placed.join(F.broadcast(bases), ["shard", "part"])  # a row a range and shard in it
            .withColumn("slot", F.col("base") + F.col("nth") - 1).drop("base", "nth"))
