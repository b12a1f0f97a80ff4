"""Sharding under the law `bytes`: minimax contiguous partition of ordered atomic groups.

Groups are the documents of equal text; they stay together.  Groups are ordered by their smallest
id and cut into contiguous runs, one per shard, so that the largest shard is as small as
possible.  The smallest feasible capacity is found by binary search: a capacity is feasible if
filling shards greedily up to it needs no more shards than there are.  Then the runs are cut greedily
at that capacity.

The greedy check only asks "what is the largest group boundary up to x?".  The boundaries (running
sums of group sizes) stay in a distributed table; the driver holds an index of INDEX ranges of equal
width with the first and last boundary in each.  Most questions, and most capacities, are settled by these
bounds alone; a question that falls inside a range fetches that range's own index, and so on down,
so the driver never holds more than a few indexes of fixed size.

Running sums and slots are numbered without collecting a shard into one task: rows are
range-partitioned and written, partitions' totals (one row each) are summed, and each partition
numbers its own rows on top.

Defined results: a null text counts as an empty one (size 1, crc32 0, same group); groups of null ids
come first; repeated rows count and get a slot each; a group larger than an even share makes its shard larger;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.llm.common import write_table

INDEX = 4096


def atomic_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(key, first_id, size): one row per distinct text; size is the bytes of all its documents.

    The key is two independent 64-bit hashes, the length and the crc32: the texts themselves are not shuffled.
    """
    return (_keyed(docs, text_col, id_col).groupBy("key")
            .agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("size")))


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b"),
                 F.octet_length(text).alias("n"), F.crc32(text.cast("binary")).alias("c")).alias("key"))


def running_sums(groups: DataFrame) -> DataFrame:
    """Written table: `groups` plus `upto`, the sum of sizes up to and with each group, in order."""
    spark = groups.sparkSession
    order = [F.col("first_id").asc_nulls_first(), F.col("key")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = write_table(groups.repartitionByRange(parts, *order)
                         .withColumn("part", F.spark_partition_id()), "shard-groups")
    totals = placed.groupBy("part").agg(F.sum("size").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("size").over(Window.partitionBy("part").orderBy(*order))
    # broadcast: one row per range partition
    return write_table(placed.withColumn("inside", inside).join(F.broadcast(before), "part")
                       .select("key", "first_id", "size", (F.col("before") + F.col("inside")).alias("upto")),
                       "shard-sums")


class Boundaries:
    """Questions about the boundaries in (lo, hi], answered by an index of ranges, in depth on demand."""

    def __init__(self, sums: DataFrame, lo: int, hi: int) -> None:
        self.sums, self.lo, self.hi = sums, lo, hi
        self.width = max(1, math.ceil((hi - lo) / INDEX))
        rows = (sums.filter((F.col("upto") > lo) & (F.col("upto") <= hi))
                .groupBy(F.expr(f"(upto - {lo + 1}) div {self.width}").alias("cell"))
                .agg(F.min("upto").alias("first"), F.max("upto").alias("last")).collect())  # INDEX rows at most
        self.cells = {r["cell"]: (r["first"], r["last"]) for r in rows}
        self.before = {}  # last boundary before each cell
        last = lo
        for cell in range(INDEX + 1):
            self.before[cell] = last
            last = self.cells.get(cell, (0, last))[1]
        self.finer: dict[int, Boundaries] = {}

    def bounds(self, x: int) -> tuple[int, int]:
        """(at least, at most) the largest boundary up to x, without fetching anything."""
        if x <= self.lo:
            return self.lo, self.lo
        cell = min((x - self.lo - 1) // self.width, INDEX)
        first, last = self.cells.get(cell, (x + 1, x + 1))
        if x < first:
            return self.before[cell], self.before[cell]
        if x >= last:
            return last, last
        if cell in self.finer:
            return self.finer[cell].bounds(x)
        return first, min(x, last - 1)

    def floor(self, x: int) -> int:
        """The largest boundary up to x (`lo` if none)."""
        low, high = self.bounds(x)
        if low == high:
            return low
        cell = (x - self.lo - 1) // self.width
        if cell not in self.finer:
            first, last = self.cells[cell]
            self.finer[cell] = Boundaries(self.sums, first, last)
        return self.finer[cell].floor(x)


def _fits(jump, capacity: int, total: int, shards: int) -> bool:
    at = 0
    for _ in range(shards):
        at = jump(at + capacity)
        if at >= total:
            return True
    return False


def minimax_cuts(sums: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, the boundary at which each shard ends)."""
    stats = sums.agg(F.max("upto").alias("total"), F.max("size").alias("largest")).first()
    total, largest = stats["total"], stats["largest"]
    if total is None:
        return 0, [0] * shards
    marks = Boundaries(sums, 0, total)

    def feasible(capacity: int) -> bool:
        if _fits(lambda x: min(marks.bounds(x)[0], total), capacity, total, shards):
            return True
        if not _fits(lambda x: min(marks.bounds(x)[1], total), capacity, total, shards):
            return False
        return _fits(marks.floor, capacity, total, shards)

    low = max(largest, -(-total // shards))
    high = low + largest
    while low < high:
        middle = (low + high) // 2
        if feasible(middle):
            high = middle
        else:
            low = middle + 1
    cuts, at = [], 0
    for _ in range(shards):
        at = marks.floor(at + low)
        cuts.append(at)
    return low, cuts


def assign_shards(docs: DataFrame, shards: int = 8, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per document.

    Slots number a shard's documents by id (ties by hash and by place in the written file)."""
    spark = docs.sparkSession
    sums = running_sums(atomic_groups(docs, text_col, id_col))
    _, cuts = minimax_cuts(sums, shards)
    shard = F.lit(0)
    for cut in cuts[:-1]:
        shard = shard + (F.col("upto") > cut).cast("int")
    where = sums.select("key", shard.alias("shard"))
    rows = _keyed(docs, text_col, id_col).join(where, "key").select(
        "doc_id", "size", "text_crc32", "shard", F.col("key.a").alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = write_table(rows.repartitionByRange(parts, "shard", *order)
                         .withColumn("part", F.spark_partition_id()), "shard-rows")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    run = F.sum("n").over(Window.partitionBy("shard").orderBy("part"))
    before = counts.select("shard", "part", (run - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order))
    # broadcast: a row per range partition and shard that meet, fewer than partitions + shards
    return (placed.withColumn("number", number).join(F.broadcast(before), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("number") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
