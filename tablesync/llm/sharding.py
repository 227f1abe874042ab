"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id and text, so it never changes, and slots are thousands
of small, even parts. Rows that repeat both are numbered, and the number of the second and
later ones goes into their hash: no group of copies, and no repeated row, fills a slot. Bytes and rows are summed per slot; the map gives each slot a shard,
the largest slots first, each to the shard with the fewest bytes. Maps are stored as
`version=N` folders of one table and never overwritten. A rebalance edits the newest one:
slots leave shards that hold more than their share (or that are gone) and nothing else moves.

Only the map, `n_slots` rows, is handled by the driver and broadcast. Positions in a shard are
a slot's first position plus a record's rank in its slot, so no task sorts a whole shard.

Null texts have no bytes; null and repeated ids are allowed, since the text is hashed as well.
An empty table gives an empty result and a map of empty slots. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablesync.llm.common import settled

SLOTS = 8192
#: Bytes that a record takes besides its text.
RECORD_BYTES = 8


@dataclass(frozen=True)
class Slot:
    slot: int
    shard: int
    bytes: int
    rows: int


def sized(docs: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of each row of `docs` (doc_id, text); written once."""
    text = F.coalesce("text", F.lit(""))
    rows = settled(
        docs.select(
            "doc_id",
            (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64("doc_id", "text").alias("h1"),
            F.xxhash64(F.lit(1), "doc_id", "text").alias("h2"),
            F.spark_partition_id().alias("task"),
        )
    )
    # How often a task has a row, summed there first: few rows, however often a row repeats.
    key = ["h1", "h2"]
    counts = rows.groupBy(*key, "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*key).orderBy("task")
    placed = counts.select(
        *key, "task", (F.sum("n").over(before) - F.col("n")).alias("first"), F.sum("n").over(Window.partitionBy(*key)).alias("all")
    ).where("all > 1")
    # Only repeated rows are numbered; those of one task are in one group, which is no larger than the task.
    repeated = rows.join(placed, [*key, "task"], "left")
    own = F.row_number().over(Window.partitionBy(*key, "task").orderBy("size"))
    again = repeated.where("all is not null").withColumn("number", F.col("first") + own - 1)
    once = repeated.where("all is null").withColumn("number", F.lit(0).cast("long"))
    hashed = F.when(F.col("number") == 0, F.col("h1")).otherwise(F.xxhash64("h1", "h2", "number"))
    slot = F.pmod(hashed, F.lit(n_slots)).cast("int").alias("virtual_slot")
    return settled(again.unionByName(once).select("doc_id", "size", "text_crc32", slot))


def measured(records: DataFrame, n_slots: int = SLOTS) -> dict[int, tuple[int, int]]:
    """Bytes and rows of every slot; empty slots have none."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size"), F.count("*"))
    return {slot: (0, 0) for slot in range(n_slots)} | {slot: (size, rows) for slot, size, rows in sums.collect()}


def _placed(slots: dict[int, tuple[int, int]], kept: dict[int, int], n_shards: int) -> list[Slot]:
    """All slots: `kept` stay, the others go, largest first, to the shard with the fewest bytes."""
    held = [0] * n_shards
    for slot, shard in kept.items():
        held[shard] += slots[slot][0]
    heap = [(size, shard) for shard, size in enumerate(held)]
    heapq.heapify(heap)
    to = dict(kept)
    for slot in sorted(slots.keys() - kept.keys(), key=lambda s: (-slots[s][0], s)):
        size, shard = heapq.heappop(heap)
        to[slot] = shard
        heapq.heappush(heap, (size + slots[slot][0], shard))
    return [Slot(slot, to[slot], *slots[slot]) for slot in sorted(slots)]


def new_map(slots: dict[int, tuple[int, int]], n_shards: int) -> list[Slot]:
    if n_shards < 1:
        raise ValueError("there must be a shard")
    return _placed(slots, {}, n_shards)


def rebalanced(old: list[Slot], slots: dict[int, tuple[int, int]], n_shards: int) -> list[Slot]:
    """`old` edited for new bytes or another number of shards; a slot moves only off a shard that is too full."""
    if n_shards < 1:
        raise ValueError("there must be a shard")
    share = sum(size for size, _ in slots.values()) / n_shards
    kept: dict[int, int] = {}
    held = [0] * n_shards
    for entry in sorted(old, key=lambda e: (-slots[e.slot][0], e.slot)):
        size = slots[entry.slot][0]
        if entry.shard < n_shards and held[entry.shard] + size <= share:
            kept[entry.slot] = entry.shard
            held[entry.shard] += size
    return _placed(slots, kept, n_shards)


def store_map(spark: SparkSession, entries: list[Slot], path: str, version: int) -> None:
    rows = [(e.slot, e.shard, e.bytes, e.rows) for e in entries]
    frame = spark.createDataFrame(rows, "slot int, shard int, bytes long, rows long")
    frame.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[Slot]]:
    """A version of the map, the newest if none is named."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).select("slot", "shard", "bytes", "rows").collect()
    return version, [Slot(*row) for row in sorted(rows)]


def assigned(records: DataFrame, entries: list[Slot]) -> DataFrame:
    """`records` (of `sized`) with their shard and their position there, gapless from 0."""
    spark = records.sparkSession
    before: dict[int, int] = {}
    rows = []
    for e in entries:
        rows.append((e.slot, e.shard, before.get(e.shard, 0)))
        before[e.shard] = before.get(e.shard, 0) + e.rows
    places = spark.createDataFrame(rows, "virtual_slot int, shard int, first long")
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("rank", rank)
        .join(F.broadcast(places), "virtual_slot")  # as many rows as there are slots
        .withColumn("slot", F.col("first") + F.col("rank") - 1)
        .drop("first", "rank")
    )
