"""Shards of near equal size: best-fit-decreasing bin packing of indivisible groups.

Groups go in order of falling size, each into the open bin with the least room that still holds
it, found in a balanced tree (a treap) of bins by room. No task sees all groups: each of many
tasks packs the groups dealt to it into small bins of a fixed capacity, and these bins are the
items of the next level, until so few are left that one task packs them into the shards. There
items above the even share have a shard each, and for the others the smallest capacity that needs
no more than the remaining shards is searched for.
"""

from __future__ import annotations

import random
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stationfield.llm.common import hot_join, packed, parts, stored

#: Items a task packs at once.
TASK_ITEMS = 50_000
#: Items of the last task for each shard, where that is more.
ITEMS_PER_SHARD = 8
#: Bins below the last level hold this part of a shard.
FINENESS = 512
#: Rows numbered in one task.
SLOT_ROWS = 50_000


class RoomTree:
    """Open bins in a treap ordered by (room, bin)."""

    def __init__(self) -> None:
        self._root: list | None = None  # [key, priority, left, right]
        self._random = random.Random(0)

    def _split(self, node, key):
        """Two trees: keys below `key`, and the others."""
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
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high

    def add(self, room: int, bin_: int) -> None:
        low, high = self._split(self._root, (room, bin_))
        self._root = self._merge(self._merge(low, [(room, bin_), self._random.random(), None, None]), high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the bin with the least room of at least `size`."""
        node, best = self._root, None
        while node is not None:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            low, rest = self._split(self._root, best)
            _, high = self._split(rest, (best[0], best[1] + 1))
            self._root = self._merge(low, high)
        return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item. An item above the capacity has a bin of its own."""
    tree, bins, n_bins = RoomTree(), np.empty(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        found = tree.tightest(size)
        room, bin_ = found if found else (max(capacity, size), n_bins)
        n_bins += found is None
        bins[i] = bin_
        if room > size:
            tree.add(room - size, bin_)
    return bins


def even_share(largest: np.ndarray, total: int, n: int) -> tuple[int, int, int]:
    """How many items, the largest, have a shard of their own, and bytes and shards for the others.

    An item has one if it is above the even share of what is left without the items before it.
    `largest` are the sizes in falling order, of which the first `n` - 1 are enough.
    """
    alone = 0
    for size in largest.tolist():
        if size * (n - alone) <= total:
            break
        total -= size
        alone += 1
    return alone, total, n - alone


def into_shards(sizes: np.ndarray, n: int) -> np.ndarray:
    """The shard of each item: items above the even share alone, the others by best fit.

    No shard stays empty as long as another has two items.
    """
    order = np.argsort(-sizes, kind="stable")
    alone, _, left = even_share(sizes[order], int(sizes.sum()), n)
    bins = np.empty(len(sizes), np.int64)
    bins[order[:alone]] = np.arange(alone)
    others = np.sort(order[alone:])
    if len(others):
        bins[others] = alone + _least_capacity(sizes[others], left)
    load, count = np.bincount(bins, sizes, n), np.bincount(bins, minlength=n)
    while not count.all() and count.max() > 1:
        full = int(np.where(count > 1, load, -1).argmax())
        inside = np.flatnonzero(bins == full)
        half = into_shards(sizes[inside], 2) == 1
        bins[inside[half]] = count.argmin()
        load, count = np.bincount(bins, sizes, n), np.bincount(bins, minlength=n)
    return bins


def _least_capacity(sizes: np.ndarray, n: int) -> np.ndarray:
    """The bin of each item, by the smallest capacity found with which best fit needs `n` bins."""
    low, high = max(-(-int(sizes.sum()) // n), int(sizes.max(initial=1))), None
    best, tried = None, low
    while high is None or high - low > max(1, low // 100_000):
        bins = best_fit_decreasing(sizes, tried)
        if bins.max(initial=0) < n:
            best, high = bins, tried
        else:
            low = tried
        if high is None:
            tried = low + max(1, low // 1000)
        else:
            tried = (low + high) // 2
        if high is not None and tried == low:
            break
    return best


def _level(items: DataFrame, n_items: int, capacity: int) -> DataFrame:
    """(item, size) to (item, size, bin): every task packs its share of the items.

    Each in order of its items, so that a task that runs again packs alike.
    """

    def fill(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("item", ignore_index=True)
        bins = best_fit_decreasing(p["size"].to_numpy(), capacity) + (int(p["part"].iloc[0]) << 32)
        return p.assign(bin=bins)[["item", "size", "bin"]]

    dealt = items.withColumn("part", F.expr(f"cast(pmod(xxhash64(item), {parts(n_items, TASK_ITEMS)}) AS int)"))
    return dealt.groupBy("part").applyInPandas(fill, "item string, size bigint, bin bigint")


def shard_groups(groups: DataFrame, n_shards: int) -> DataFrame:
    """(item string, size) to (item, shard).

    All bins of a task but one are at least half full, so a level leaves some thousand bins for each
    shard and one for each task. Where that is still too much for the task that fills the shards, the bins of
    the next level are twice as large, up to half a shard: of very many shards it takes some items each.
    """
    total, n_items = groups.agg(F.sum("size"), F.count("*")).first()
    maps, items = [], groups
    if n_items > TASK_ITEMS:
        largest = groups.orderBy(F.desc("size")).limit(n_shards).select("size").collect()  # at most n_shards sizes
        _, rest, left = even_share(np.array([r["size"] for r in largest]), total, n_shards)
        capacity, largest_bin = max(1, rest // (left * FINENESS)), max(1, rest // (2 * left))
    most = max(TASK_ITEMS, ITEMS_PER_SHARD * n_shards)
    while n_items > most:
        level = stored(_level(items, n_items, capacity), "shard-level")
        maps.append(level.select("item", F.col("bin").cast("string").alias("up")))
        items = level.groupBy(F.col("bin").cast("string").alias("item")).agg(F.sum("size").alias("size"))
        before, n_items = n_items, items.count()
        if n_items == before and capacity >= largest_bin:
            break  # only items above half a shard are left
        capacity = min(2 * capacity, largest_bin)

    def last(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("item", ignore_index=True)
        return p.assign(shard=into_shards(p["size"].to_numpy(), n_shards).astype(np.int32))[["item", "shard"]]

    top = items.withColumn("part", F.lit(0)).groupBy("part").applyInPandas(last, "item string, shard int")
    if maps:
        top = stored(top, "shard-top")  # at most TASK_ITEMS rows
        for level in reversed(maps):
            up = F.broadcast(top) if level is maps[-1] else top
            top = level.join(up.withColumnRenamed("item", "up"), "up").select("item", "shard")
    return top


def numbered(rows: DataFrame, n_rows: int, key: str, order: list[str]) -> DataFrame:
    """`slot`: 0, 1, 2, ... within each `key`, without bringing a key's rows together.

    Rows are dealt to blocks by hash, numbered within a block, and moved by the counts of the
    blocks before, of which there is one number each.
    """
    n = parts(n_rows, SLOT_ROWS)
    rows = rows.withColumn("block", F.expr(f"cast(pmod(xxhash64({', '.join(order)}), {n}) AS int)"))
    before = rows.groupBy(key, "block").count().withColumn(
        "before", F.sum("count").over(Window.partitionBy(key).orderBy("block")) - F.col("count")
    )
    place = F.row_number().over(Window.partitionBy(key, "block").orderBy(*order)) - 1
    return rows.withColumn("place", place).join(before.drop("count"), [key, "block"]).withColumn(
        "slot", (F.col("before") + F.col("place")).cast("long")
    ).drop("block", "before", "place")


def shard(docs: DataFrame, n_shards: int = 8, text: str = "text") -> DataFrame:
    """`row`, `group`, `size` and `shard` for every row. Equal texts share a shard.

    The size of a row is its text's UTF-8 bytes and 1 more; null texts, a group of their own, count
    as none. A group larger than an even share is not cut: it has a shard of its own, larger than the
    others, which share the remaining bytes evenly.
    """
    key = F.coalesce(F.sha2(F.col(f"`{text}`"), 256), F.lit("null"))
    rows = packed(docs, group=key, size=F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long") + 1)
    groups = stored(rows.groupBy(F.col("group").alias("item")).agg(F.sum("size").alias("size"), F.count("*").alias("times")), "shard-groups")
    placed = shard_groups(groups.drop("times"), n_shards).join(groups.select("item", "times"), "item")
    placed = stored(placed.withColumnRenamed("item", "group"), "shard-groups-placed")
    n_rows = groups.agg(F.sum("times")).first()[0] or 0
    return hot_join(rows, placed, "group", "times", n_rows).drop("times")


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, text: str = "text") -> None:
    """The rows of `docs` below `path`, in a folder `_shard=` for each shard; with more underscores if
    the table has a column of that name."""
    name, taken = "_shard", {c.lower() for c in docs.columns}
    while name in taken:  # a column of the table
        name = f"_{name}"
    shard(docs, n_shards, text).select("row.*", F.col("shard").alias(name)).write.partitionBy(name).parquet(path)


def assignment(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    crc = F.coalesce(F.crc32(F.coalesce("text", F.lit(""))), F.lit(0)).cast("long")
    small = docs.select("doc_id", crc.alias("text_crc32"), "text")
    rows = shard(small, n_shards).select("row.doc_id", "size", "row.text_crc32", "shard")
    rows = stored(rows, "shard-rows")
    return numbered(rows, rows.count(), "shard", ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
