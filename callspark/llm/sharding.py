"""Shards by fixed virtual slots.

Records are hashed into a fixed number of virtual slots. Bytes and rows are summed per slot, and a
map from slots to shards, stored with a version, is edited until the shards hold nearly equal
bytes. Rebalancing or adding a shard edits the map alone: slots move as wholes, and most stay.

Only the slot table, whose length is the parameter ``slots``, is handled by the driver. Records are
shuffled once, without their texts, to number the rows of a shard. Rows that are equal in id and
text share a slot; rows without an id are spread by all their columns.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callspark.llm.common import written

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """A version of the map: the shard of each virtual slot."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def column(self, slot: Column) -> Column:
        return looked_up(self.shard_of, slot).cast("int")

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per slot: version, shards, slot, shard."""
        return spark.range(len(self.shard_of)).select(
            F.lit(self.version).alias("version"), F.lit(self.shards).alias("shards"),
            F.col("id").cast("int").alias("virtual_slot"), self.column(F.col("id")).alias("shard"),
        )


def stored_map(maps: DataFrame) -> SlotMap:
    """The last version of a stored table of maps; it has one row per virtual slot and version."""
    last = maps.agg(F.max("version")).first()[0]
    rows = maps.filter(F.col("version") == last).orderBy("virtual_slot").collect()
    return SlotMap(last, rows[0]["shards"], tuple(r["shard"] for r in rows))


def looked_up(values, at: Column) -> Column:
    """The value at a place of a constant list, which travels as one literal."""
    constant = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    return F.element_at(constant, (at + 1).cast("int"))


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    return SlotMap(1, shards, tuple(i % shards for i in range(slots)))


def rebalanced(current: SlotMap, load: list[int], shards: int | None = None) -> SlotMap:
    """The next version of the map for the bytes of each slot.

    A shard keeps its slots, the largest first, as long as they fit its equal share. The rest go,
    the largest first, to the shard with the least bytes. Last, the fullest shard hands slots to
    the emptiest while that narrows the gap. With more shards, all that moves leaves a full shard.
    """
    shards = shards or current.shards
    share = sum(load) / shards
    held = [0] * shards
    shard_of = list(current.shard_of)
    moving = []
    for slot in sorted(range(len(load)), key=lambda s: (-load[s], s)):
        home = shard_of[slot]
        if home < shards and held[home] + load[slot] <= share:
            held[home] += load[slot]
        else:
            moving.append(slot)
    heap = [(held[s], s) for s in range(shards)]
    heapq.heapify(heap)
    for slot in moving:
        bytes_, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (bytes_ + load[slot], shard))
    held = [0] * shards
    members: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        held[shard] += load[slot]
        members[shard].append(slot)
    for _ in range(8 * shards):
        full, empty = max(range(shards), key=held.__getitem__), min(range(shards), key=held.__getitem__)
        gap = held[full] - held[empty]
        # A slot of half the gap would make both equal; any smaller than the gap narrows it.
        fitting = [s for s in members[full] if 0 < load[s] < gap]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(2 * load[s] - gap), s))
        members[full].remove(slot)
        members[empty].append(slot)
        shard_of[slot] = empty
        held[full] -= load[slot]
        held[empty] += load[slot]
    return SlotMap(current.version + 1, shards, tuple(shard_of))


def slotted(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per record its id, size (bytes of the text and one more), text checksum and virtual slot."""
    body = F.coalesce(documents["text"], F.lit(""))
    return documents.select(
        documents["doc_id"].alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.when(documents["doc_id"].isNull(), F.to_json(F.struct(*[documents[c] for c in documents.columns]))).alias("nameless"),
    ).select(
        "doc_id", "size", "text_crc32",
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.xxhash64("nameless")), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_loads(records: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot, summed on the map side first; as many numbers as slots."""
    load, rows = [0] * slots, [0] * slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        load[r["virtual_slot"]], rows[r["virtual_slot"]] = r["b"], r["n"]
    return load, rows


def place(records: DataFrame, slot_map: SlotMap, rows: list[int]) -> DataFrame:
    """The shard of each record and its place there, counted without gaps from 0.

    A place is the number of rows in the earlier virtual slots of the shard, which the slot table
    tells, and the rank inside the virtual slot; so no task sees more than some virtual slots.
    """
    before, counted = [], [0] * slot_map.shards
    for slot, shard in enumerate(slot_map.shard_of):
        before.append(counted[shard])
        counted[shard] += rows[slot]
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return records.select(
        "*",
        slot_map.column(F.col("virtual_slot")).alias("shard"),
        (looked_up(before, F.col("virtual_slot")) + rank - 1).cast("long").alias("slot"),
    )


def shard(documents: DataFrame, shards: int = 16, slots: int = SLOTS, earlier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All documents with shard and place under the law of equal bytes, and the stored maps.

    ``earlier`` is the table of maps of a former run: its last version is edited for the bytes
    there are now, so that most documents keep their shard, and ``slots`` is the number it has. Without
    it the first map deals slots in turn. Columns of ``documents`` other than id and text are left out; those of
    rows without an id decide with the text where they go. Null texts have one byte; an empty table gives no
    rows. The second result holds every version of the map.
    """
    spark = documents.sparkSession
    first = first_map(shards, slots) if earlier is None else stored_map(earlier)
    slots = len(first.shard_of)
    records = written(slotted(documents, slots), "slotted")
    load, rows = slot_loads(records, slots)
    second = rebalanced(first, load, shards)
    before = first.table(spark) if earlier is None else earlier
    maps = written(before.unionByName(second.table(spark)), "slot-map")
    placed = place(records, second, rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(second.version).alias("map_version"),
    )
    return placed, maps
