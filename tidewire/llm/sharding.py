"""Sharding: best-fit decreasing of indivisible groups, the tightest bin found in a balanced tree."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import row_uid, utf8

#: Groups that a lot has on average; lots are packed for themselves.
LOT_GROUPS = 20_000
#: A group is large if it weighs more than a shard's share divided by this: at most shards x LARGE such groups exist.
LARGE = 64
#: Rows that are numbered in one task.
CELL_ROWS = 20_000


class Tree:
    """Bins by (room, bin) in a treap: a search tree whose random priorities keep it balanced."""

    class Node:
        __slots__ = ("key", "order", "left", "right")

        def __init__(self, key, order):
            self.key, self.order, self.left, self.right = key, order, None, None

    def __init__(self, seed: int = 1):
        self.root, self.random = None, random.Random(seed)

    def _split(self, node, key):
        """Two trees: keys below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, high = self._split(node.right, key)
            return node, high
        low, node.left = self._split(node.left, key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low.order > high.order:
            low.right = self._merge(low.right, high)
            return low
        high.left = self._merge(low, high.left)
        return high

    def add(self, room: int, number: int) -> None:
        low, high = self._split(self.root, (room, number))
        self.root = self._merge(self._merge(low, self.Node((room, number), self.random.random())), high)

    def remove(self, room: int, number: int) -> None:
        low, rest = self._split(self.root, (room, number))
        _, high = self._split(rest, (room, number + 1))
        self.root = self._merge(low, high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least room that is enough."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        return best

    def roomiest(self) -> tuple[int, int] | None:
        node = self.root
        while node and node.right:
            node = node.right
        return node.key if node else None


def best_fit_decreasing(sizes: list[int], rooms: list[int], capacity: int | None = None) -> tuple[list[int], list[int]]:
    """(bin of each size, rooms left). Sizes are given largest first, bins by the room they start with.

    What fits nowhere opens a new bin of ``capacity``, or goes where most room is if there is no ``capacity``.
    """
    tree, rooms, found = Tree(), list(rooms), []
    for number, room in enumerate(rooms):
        tree.add(room, number)
    for size in sizes:
        at = tree.tightest(size)
        if at is None and capacity is not None:
            rooms.append(max(size, capacity))
            at = rooms[-1], len(rooms) - 1
            tree.add(*at)
        room, number = at or tree.roomiest()
        tree.remove(room, number)
        tree.add(room - size, number)
        rooms[number] = room - size
        found.append(number)
    return found, rooms


def fair_rooms(total: int, largest: list[int], shards: int) -> int:
    """The room per shard when groups above an equal share get a shard of their own (``largest``: first the largest)."""
    rest, left = total, shards
    for size in largest[: shards - 1]:
        if size * left <= rest:
            break
        rest, left = rest - size, left - 1
    return -(-rest // left)


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``shard`` for each (key binary, weight long): weights per shard nearly equal, no group divided.

    Large groups, whose number is bounded by their size, are placed first. All others are dealt at random into lots;
    each lot fills the shards' remaining room, scaled to its weight. ``groups`` should be a stored table.
    """
    total, count = groups.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.count("*")).first()
    least = max(1, total // (shards * LARGE))
    large = groups.where(F.col("weight") > least).orderBy(F.desc("weight"), "key").limit(shards * LARGE).collect()
    room = fair_rooms(total, [g.weight for g in large], shards)
    placed, rooms = best_fit_decreasing([g.weight for g in large], [room] * shards)
    rooms = [max(0, r) for r in rooms]
    free = max(1, sum(rooms))
    spark = groups.sparkSession
    first = spark.createDataFrame([(bytes(g.key), s) for g, s in zip(large, placed)], "key binary, shard int")
    lots = -(-count // LOT_GROUPS) or 1

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("weight", "descending"), ("key", "ascending")])
        weights = rows.column("weight").to_pylist()
        here = [r * sum(weights) // free for r in rooms]
        found, _ = best_fit_decreasing(weights, here)
        return pa.table([rows.column("key"), pa.array(found, pa.int32())], ["key", "shard"])

    small = groups.where(F.col("weight") <= least).withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(lots)))
    return small.groupBy("_lot").applyInArrow(work, "key binary, shard int").unionByName(first)


def fill_shards(groups: DataFrame, capacity: int) -> DataFrame:
    """(key, bin) with as few bins of ``capacity`` as best-fit decreasing finds in each lot; bins are not shared by lots.

    A group above ``capacity`` has a bin for itself.
    """
    lots = -(-groups.count() // LOT_GROUPS) or 1

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("weight", "descending"), ("key", "ascending")])
        found, _ = best_fit_decreasing(rows.column("weight").to_pylist(), [], capacity)
        lot = rows.column("_lot")[0].as_py()
        return pa.table([rows.column("key"), pa.array([lot << 32 | b for b in found], pa.int64())], ["key", "bin"])

    dealt = groups.withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(lots)))
    return dealt.groupBy("_lot").applyInArrow(work, "key binary, bin long")


def number_rows(rows: DataFrame, shard: str, count: int, shards: int) -> DataFrame:
    """``slot``: numbers from 0 without gaps in each shard. ``rows`` should be a stored table.

    Rows are dealt into small cells of a shard and numbered there; a cell starts where those before it end.
    """
    cells = -(-count // (shards * CELL_ROWS)) or 1
    dealt = rows.withColumn("_uid", row_uid(rows)).withColumn("_cell", F.pmod(F.xxhash64("_uid"), F.lit(cells)))
    sizes = dealt.groupBy(shard, "_cell").agg(F.count("*").alias("_n"))
    # One row per cell: a few per shard and 20,000 rows.
    before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(shard, "_cell").orderBy("_uid")) - 1
    numbered = dealt.withColumn("_at", inside).join(starts, [shard, "_cell"])
    return numbered.withColumn("slot", F.col("_start") + F.col("_at")).drop("_uid", "_cell", "_at", "_start")


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard from 0 to ``shards - 1`` and its place there; documents of equal text stay together.

    The law is ``bytes``: sizes (bytes of the text plus 1) sum up to nearly the same in each shard, as far as groups
    that weigh more than a share allow. A NULL text counts as an empty one. ``doc_id`` is passed on, NULL as well;
    repeated rows are a group. The texts themselves are never shuffled.
    """
    raw = utf8("_text")
    named = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("_text"))
    sized = named.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("key"),
    )
    sized = materialize(sized, "sized")
    groups = materialize(sized.groupBy("key").agg(F.sum("size").alias("weight")), "groups")
    shard_of = assign_groups(groups, shards)
    # A text that very many rows share makes a large partition here, which the adaptive skew join splits.
    placed = materialize(sized.join(shard_of, "key").drop("key"), "placed")
    numbered = number_rows(placed, "shard", placed.count(), shards)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
