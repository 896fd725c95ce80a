"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frames import text_of, written

# Groups are packed one by one down to this part of a shard, smaller ones in blocks.
UNITS_PER_SHARD = 1024
# Rows are numbered in so many cells a shard at least; more when a cell would pass CELL_ROWS.
CELL_ROWS = 200_000


class FreeSpace:
    """Open bins ordered by free space: a treap, balanced by pseudo-random priorities."""

    def __init__(self):
        self.root, self.seed = None, 1

    def _split(self, node, key):
        """Nodes below ``key`` and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            below, above = self._split(node[3], key)
            return (node[0], node[1], node[2], below), above
        below, above = self._split(node[2], key)
        return below, (node[0], node[1], above, node[3])

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return (a[0], a[1], a[2], self._merge(a[3], b))
        return (b[0], b[1], self._merge(a, b[2]), b[3])

    def add(self, free: int, name: int) -> None:
        self.seed = self.seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
        below, above = self._split(self.root, (free, name))
        self.root = self._merge(self._merge(below, ((free, name), self.seed >> 20, None, None)), above)

    def take_tightest(self, size: int):
        """Remove and return (free, name) of the bin with the least space that is enough."""
        below, above = self._split(self.root, (size, -1))
        if above is None:
            self.root = below
            return None
        node = above
        while node[2] is not None:
            node = node[2]
        _, rest = self._split(above, (node[0][0], node[0][1] + 1))
        self.root = self._merge(below, rest)
        return node[0]


def pack(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of every item, the largest first into the tightest bin that takes it.

    Without ``most`` new bins open as needed. With it, None if so many don't suffice.
    """
    free, placed, bins = FreeSpace(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = free.take_tightest(sizes[i])
        if found is None:
            if most is not None and (bins == most or sizes[i] > capacity):
                return None
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        space, placed[i] = found
        free.add(space - sizes[i], placed[i])
    return placed


def pack_evenly(sizes: list[int], shards: int) -> list[int]:
    """Bins of the least capacity, found by bisection, at which ``shards`` bins suffice."""
    low = max([-(-sum(sizes) // shards), *sizes])
    high = max(2 * low, 1)
    while low < high:
        middle = (low + high) // 2
        if pack(sizes, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return pack(sizes, high, shards)


def shard_evenly(docs: DataFrame, shards: int = 8, units_per_shard: int = UNITS_PER_SHARD) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``shards`` shards of near
    equal bytes; equal texts go together.

    The size of a row is the UTF-8 length of its text (null: empty) plus 1. Groups of
    at least 1/1024 of a shard are packed one by one: there can be 8192 of them at most.
    Smaller ones are hashed into as many blocks, packed like groups. So the packing has
    a fixed number of items whatever the input, and only that list is broadcast. A group
    larger than a whole shard can't stay whole: it is cut by doc_id into parts of about a
    quarter of a shard. Rows with equal doc_id and text always go together.

    Columns: doc_id, size, text_crc32, shard, slot (gapless from 0 in the shard, in the
    order of a hash of doc_id). Nulls in doc_id are a value like any other.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text_of(), 256)).alias("digest"),
    )
    rows = written(rows, "sizes")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    shard_bytes = max(1, -(-total // shards))
    blocks, least = shards * units_per_shard, max(1, shard_bytes // units_per_shard)
    large = (
        groups.filter(F.col("size") >= least)
        .select("digest", F.when(F.col("size") > shard_bytes,
                                 F.ceil(F.col("size") * 4 / shard_bytes)).otherwise(1)
                .cast("long").alias("parts"))
    )
    # At most total / least rows: the sizes of the groups add up to the total.
    large = written(large, "large")
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1)))
    block = F.pmod(F.xxhash64("digest"), F.lit(blocks))
    united = rows.join(F.broadcast(large), "digest", "left").select(
        "doc_id", "size", "text_crc32",
        F.when(F.col("parts").isNotNull(), F.col("digest")).alias("one"),
        F.when(F.col("parts").isNotNull(), part).otherwise(block).alias("many"),
    )
    # At most twice the number of blocks, and some more for each cut group: one small task.
    units = united.groupBy("one", "many").agg(F.sum("size").alias("size"))

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(one=frame["one"].map(lambda d: bytes(d) if d is not None else b""))
        frame = frame.sort_values(["size", "one", "many"], ignore_index=True)
        frame["shard"] = pack_evenly([int(s) for s in frame["size"]], shards)
        return frame[["one", "many", "shard"]]

    packed = written(
        units.groupBy(F.lit(0).alias("all")).applyInPandas(
            assign, "one binary, many long, shard int"
        ),
        "units",
    ).withColumnRenamed("one", "u_one").withColumnRenamed("many", "u_many")
    same = (F.coalesce("one", F.lit(b"")) == F.col("u_one")) & (F.col("many") == F.col("u_many"))
    placed = united.join(F.broadcast(packed), same).select("doc_id", "size", "text_crc32", "shard")
    return with_slots(placed, count)


def with_slots(placed: DataFrame, rows: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Number the rows of each shard from 0, in cells by a hash of doc_id, each cell
    after the ones before it; no task sorts a whole shard."""
    cells = max(16, -(-rows // cell_rows))
    celled = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        celled.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
        .withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .select("shard", "cell", "offset")
    )
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (
        celled.withColumn("number", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", "shard",
                (F.col("number") + F.col("offset")).cast("long").alias("slot"))
    )
