"""Sharding by best-fit decreasing: indivisible groups enter the shard with the tightest remaining capacity.

Groups (rows with one text) are first packed into blocks, each hash part of the groups on its own; a block is a
64th to a 512th of a shard, by its part, or one larger group: small blocks fill what large ones leave. The blocks, few and bounded in number, are then packed into shards with the
smallest capacity for which the shards suffice. A group that is larger than that capacity has a shard of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.common import written

SHARDS = 40
ROW_BYTES = 16
BLOCKS_PER_SHARD = 64
GROUPS_PER_PART, LEAST_PARTS = 100_000, 8
CELL_ROWS = 100_000


class Treap:
    """A balanced search tree of (room, bin): insert, and take out the tightest bin with enough room."""

    def __init__(self) -> None:
        self.key: list[tuple[int, int]] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.rank: list[int] = []
        self.root, self.state = -1, 0x9E3779B9

    def _random(self) -> int:
        x = self.state
        x ^= (x << 13) & 0xFFFFFFFF
        x ^= x >> 17
        x ^= (x << 5) & 0xFFFFFFFF
        self.state = x
        return x

    def _split(self, node: int, key: tuple[int, int]) -> tuple[int, int]:
        """Trees of the keys below ``key`` and of the others."""
        if node < 0:
            return -1, -1
        if self.key[node] < key:
            self.high[node], right = self._split(self.high[node], key)
            return node, right
        left, self.low[node] = self._split(self.low[node], key)
        return left, node

    def _join(self, a: int, b: int) -> int:
        if a < 0 or b < 0:
            return max(a, b)
        if self.rank[a] > self.rank[b]:
            self.high[a] = self._join(self.high[a], b)
            return a
        self.low[b] = self._join(a, self.low[b])
        return b

    def insert(self, room: int, bin_: int) -> None:
        self.key.append((room, bin_))
        self.low.append(-1)
        self.high.append(-1)
        self.rank.append(self._random())
        left, right = self._split(self.root, (room, bin_))
        self.root = self._join(self._join(left, len(self.key) - 1), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest (room, bin) with room for ``size``; none if there is none."""
        node, found = self.root, -1
        while node >= 0:
            if self.key[node] >= (size, -1):
                found, node = node, self.low[node]
            else:
                node = self.high[node]
        if found < 0:
            return None
        key = self.key[found]
        left, rest = self._split(self.root, key)
        _, right = self._split(rest, (key[0], key[1] + 1))
        self.root = self._join(left, right)
        return key


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of every item; an item above the capacity has a bin of its own. Ties go in the given order."""
    tree, bins, used = Treap(), np.zeros(len(sizes), np.int64), 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        found = tree.take(size)
        if found is None:
            room, at = max(capacity, size), used
            used += 1
        else:
            room, at = found
        bins[item] = at
        if room > size:
            tree.insert(room - size, at)
    return bins


def fit_into(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Best-fit decreasing with the smallest capacity for which ``shards`` bins suffice.

    The largest items come first: those above an even share of what is left have a shard each.
    """
    order, bins = np.argsort(-sizes, kind="stable"), np.zeros(len(sizes), np.int64)
    alone, rest = 0, int(sizes.sum())
    while alone < min(len(order), shards - 1) and sizes[order[alone]] * (shards - alone) > rest:
        rest -= int(sizes[order[alone]])
        bins[order[alone]] = alone
        alone += 1
    others, left = order[alone:], shards - alone
    if not len(others):
        return bins
    low = max(-(-rest // left), int(sizes[others[0]]))
    high = low + int(sizes[others[0]])
    while best_fit_decreasing(sizes[others], high).max() >= left:
        high += high - low + 1
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(sizes[others], middle).max() < left:
            high = middle
        else:
            low = middle + 1
    bins[others] = alone + best_fit_decreasing(sizes[others], high)
    return bins


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; rows with one text are in one shard.

    size is the text's UTF-8 bytes and 16; a null text counts as empty and belongs to the group of empty texts. slot
    numbers the rows of a shard from 0 without a gap, by block, then hash cell, then doc_id (rows without one last).
    Repeated rows stay and belong to their text's group. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit("text"), text).alias("h2"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    sums = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    sums = written(sums, "text-groups")
    total, groups = sums.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    parts = max(LEAST_PARTS, -(-groups // GROUPS_PER_PART))
    capacity = max(1, int(total) // (shards * BLOCKS_PER_SHARD))

    def to_blocks(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h1", "h2"])
        part = int(frame["part"].iloc[0])
        bins = best_fit_decreasing(frame["bytes"].to_numpy(), max(1, capacity >> part % 4))
        frame["block"] = bins * parts + frame["part"].to_numpy()
        return frame[["h1", "h2", "bytes", "n", "block"]]

    def to_shards(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        frame["shard"] = fit_into(frame["bytes"].to_numpy(), shards).astype(np.int32)
        return frame[["block", "n", "shard"]]

    blocked = written(
        sums.withColumn("part", F.pmod("h1", F.lit(parts)))
        .groupBy("part")
        .applyInPandas(to_blocks, "h1 bigint, h2 bigint, bytes bigint, n bigint, block bigint"),
        "blocks",
    )
    placed = written(
        blocked.groupBy("block")
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        .withColumn("all", F.lit(0))
        .groupBy("all")
        .applyInPandas(to_shards, "block bigint, n bigint, shard int"),
        "shards",
    )
    # A block's rows are numbered in cells of bounded size, so a huge group is not one window; they are dealt by their
    # row of the written table too, as many may share a doc_id or have none.
    cells = F.greatest(F.ceil(F.col("n") / CELL_ROWS), F.lit(1))
    where = placed.select("block", "shard", cells.alias("cells"))
    located = (
        rows.join(blocked.select("h1", "h2", "block"), ["h1", "h2"])
        .join(where, "block")
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "row"), F.col("cells")))
        .select("doc_id", "size", "text_crc32", "shard", "block", "cell")
    )
    located = written(located, "located")
    counts = located.groupBy("shard", "block", "cell").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("shard").orderBy("block", "cell")
    bases = counts.select(
        "shard", "block", "cell", (F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))).alias("base")
    )
    within = Window.partitionBy("shard", "block", "cell").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32")
    return (
        located.withColumn("nth", F.row_number().over(within))
        .join(bases, ["shard", "block", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.coalesce("base", F.lit(0)) + F.col("nth") - 1).cast("bigint").alias("slot"),
        )
    )
