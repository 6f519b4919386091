"""Sharding by fixed virtual slots, with DataFrame functions only.

Records are hashed into a fixed number of slots. The bytes of each slot are added up, and a
versioned table says which shard owns which slot. Rebalancing writes a new version that moves
as few slots as it can; records never change their slot.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import text_of, write_once

SLOTS = 8192

MAP_SCHEMA = "virtual_slot int, shard int, bytes long, n_rows long"


def virtual_slot(slots: int = SLOTS) -> Column:
    """The slot of a record from its id and text; it depends on nothing else."""
    return F.expr(f"pmod(xxhash64(doc_id, text), {slots})").cast("int")


def record_sizes(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of each row of (doc_id, text).

    size: UTF-8 bytes of the text (none for null) plus 1. text_crc32 of a null text is that of
    the empty one.
    """
    size = F.octet_length(text_of()).cast("long") + 1
    crc = F.crc32(F.encode(text_of(), "UTF-8"))
    return documents.select("doc_id", size.alias("size"), crc.alias("text_crc32"), virtual_slot(slots).alias("virtual_slot"))


def slot_sizes(records: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of each slot that has records: one entry for each slot at most."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))
    return sorted(tuple(row) for row in sums.collect())


class SlotMap:
    """Versions of the slot-to-shard map, each a table below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, owners: dict[int, int], sizes: list[tuple[int, int, int]]) -> DataFrame:
        known = {slot: (size, rows) for slot, size, rows in sizes}
        rows = [(slot, shard, *known.get(slot, (0, 0))) for slot, shard in sorted(owners.items())]
        table = self.spark.createDataFrame(rows, MAP_SCHEMA)
        table.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.path}/version={version}")

    def owners(self, version: int) -> dict[int, int]:
        return {row.virtual_slot: row.shard for row in self.read(version).collect()}


def first_map(sizes: list[tuple[int, int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slots by size, the largest first, each to the shard with the fewest bytes so far."""
    return _deal({}, sizes, shards, slots)


def rebalance(
    owners: dict[int, int], sizes: list[tuple[int, int, int]], shards: int, slots: int = SLOTS, slack: float = 0.01
) -> dict[int, int]:
    """The map edited for new sizes or another number of shards.

    Slots of shards that are gone are dealt anew. A shard keeps its slots up to (1 + slack) times
    the mean; the smallest of the others move to the emptiest shard while that makes the load more
    even. With one more shard and unchanged sizes, slots move only into it.
    """
    load = {slot: size for slot, size, _ in sizes}
    kept = {slot: shard for slot, shard in owners.items() if shard < shards}
    total = [0] * shards
    for slot, shard in kept.items():
        total[shard] += load.get(slot, 0)
    limit = (1 + slack) * sum(load.values()) / shards
    free: dict[int, int] = {}
    for slot in sorted(kept, key=lambda s: (load.get(s, 0), s)):
        shard = kept[slot]
        if load.get(slot, 0) and total[shard] > limit and total[shard] - load[slot] >= sum(load.values()) / shards:
            total[shard] -= load[slot]
            free[slot] = shard
    for slot in free:
        del kept[slot]
    return _deal(kept, sizes, shards, slots)


def _deal(kept: dict[int, int], sizes: list[tuple[int, int, int]], shards: int, slots: int) -> dict[int, int]:
    load = {slot: size for slot, size, _ in sizes}
    total = [0] * shards
    for slot, shard in kept.items():
        total[shard] += load.get(slot, 0)
    emptiest = [(size, shard) for shard, size in enumerate(total)]
    heapq.heapify(emptiest)
    owners = dict(kept)
    for slot in sorted(set(range(slots)) - set(kept), key=lambda s: (-load.get(s, 0), s)):
        size, shard = heapq.heappop(emptiest)
        owners[slot] = shard
        heapq.heappush(emptiest, (size + load.get(slot, 0), shard))
    return owners


def place_records(records: DataFrame, owners: DataFrame) -> DataFrame:
    """Adds shard and slot, the record's gapless place in its shard.

    A place is the start of the virtual slot in its shard plus the rank inside the slot, so no
    task holds more than some slots. Equal rows take neighbouring places. The map has one row for
    each slot, a fixed number, and travels to all tasks.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = owners.select(
        "virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_start")
    )
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    ranked = records.withColumn("_within", within)
    placed = ranked.join(F.broadcast(starts), "virtual_slot")
    return placed.withColumn("slot", F.col("_start") + F.col("_within") - 1).drop("_start", "_within")


def shard_documents(documents: DataFrame, shards: int = 16, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and slot of each row of (doc_id, text).

    Shards get near-equal bytes. The map is written as version 1 below `path` (by default a new
    place in the shared folder). Texts are read once; what is kept of them is a few numbers each.
    Null ids and texts hash like any value; equal rows share a virtual slot. No rows: no rows.
    """
    spark = documents.sparkSession
    records = write_once(record_sizes(documents.select("doc_id", "text"), slots), scratch_path(spark, "records"))
    sizes = slot_sizes(records)
    store = SlotMap(spark, path or scratch_path(spark, "slot-map"))
    return place_records(records, store.write(1, first_map(sizes, shards, slots), sizes))
