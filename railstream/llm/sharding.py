"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots; bytes and rows are summed per slot; a table that
says which shard holds which slot is stored under a version. Rebalancing, or another number of
shards, edits that table: records never change their slot.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railstream.llm.store import stored

SLOTS = 4096
ROW_BYTES = 16
MAP_SCHEMA = ("version int, virtual_slot int, shard int, slot_bytes long, slot_rows long, "
              "first_place long")


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of each row.

    The size is the UTF-8 length of the text plus 16; a missing text has length 0. The slot
    depends on id and text, so rows that share an id, or have none, still spread.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), crc), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_totals(rows: DataFrame) -> DataFrame:
    """Bytes and rows of each slot that has any."""
    return rows.groupBy("virtual_slot").agg(
        F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def first_map(totals: Iterable, shards: int, slots: int = SLOTS) -> list[tuple]:
    """Version 1: the largest slot goes to the shard with the fewest bytes so far, and so on.

    Slots without rows count as empty, so the table always has ``slots`` entries; that is its
    size bound, whatever the number of records.
    """
    size = {r["virtual_slot"]: (r["slot_bytes"], r["slot_rows"]) for r in totals}
    order = sorted(range(slots), key=lambda s: (-size.get(s, (0, 0))[0], s))
    heap = [(0, 0, shard) for shard in range(shards)]
    held = {}
    for slot in order:
        load, count, shard = heapq.heappop(heap)
        held[slot] = shard
        heapq.heappush(heap, (load + size.get(slot, (0, 0))[0], count + 1, shard))
    return _entries(1, held, size)


def edited_map(previous: Iterable, totals: Iterable, shards: int) -> list[tuple]:
    """The next version, for new totals or another number of shards, with few slots moved.

    Slots of shards that no longer exist move first. Then, as long as it narrows their gap, the
    fullest shard gives its largest fitting slot to the emptiest one.
    """
    previous = list(previous)
    size = {r["virtual_slot"]: (r["slot_bytes"], r["slot_rows"]) for r in totals}
    held = {r["virtual_slot"]: r["shard"] for r in previous}
    load = [0] * shards
    owned: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in held.items():
        if shard < shards:
            owned[shard].add(slot)
            load[shard] += size.get(slot, (0, 0))[0]
        else:
            homeless.append(slot)

    def give(slot: int, shard: int) -> None:
        held[slot] = shard
        owned[shard].add(slot)
        load[shard] += size.get(slot, (0, 0))[0]

    for slot in sorted(homeless, key=lambda s: (-size.get(s, (0, 0))[0], s)):
        give(slot, min(range(shards), key=lambda s: (load[s], s)))
    while True:
        low = min(range(shards), key=lambda s: (load[s], s))
        high = max(range(shards), key=lambda s: (load[s], -s))
        gap = load[high] - load[low]
        fits = [s for s in owned[high] if 0 < size.get(s, (0, 0))[0] < gap]
        if not fits:
            break
        # The best move is the slot nearest to half of the gap.
        slot = min(fits, key=lambda s: (abs(2 * size[s][0] - gap), s))
        if max(load[high] - size[slot][0], load[low] + size[slot][0]) >= load[high]:
            break
        owned[high].remove(slot)
        load[high] -= size[slot][0]
        give(slot, low)
    return _entries(max(r["version"] for r in previous) + 1, held, size)


def _entries(version: int, held: dict[int, int], size: dict[int, tuple[int, int]]) -> list[tuple]:
    place: dict[int, int] = {}
    rows = []
    for slot in sorted(held):
        shard = held[slot]
        held_bytes, held_rows = size.get(slot, (0, 0))
        rows.append((version, slot, shard, held_bytes, held_rows, place.get(shard, 0)))
        place[shard] = place.get(shard, 0) + held_rows
    return rows


def save_map(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    """Store one version of the map and return it."""
    return stored(spark.createDataFrame(entries, MAP_SCHEMA).coalesce(1), f"slot-map-v{entries[0][0]}")


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows with their shard and their place in it, gapless from 0.

    A place is the number of rows in the shard's earlier slots, from the map, plus the row's
    number in its own slot; so no task orders a whole shard.
    """
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (rows
            .withColumn("place", F.row_number().over(within) - 1)
            # The map has one row per virtual slot, a fixed number.
            .join(F.broadcast(slot_map), "virtual_slot")
            .withColumn("slot", F.col("first_place") + F.col("place")))


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Each row's shard under version 1 of the map; shards are nearly equal in bytes.

    Rows in, rows out: repeated rows, missing ids and missing texts keep their rows. An empty
    table gives no rows. Other columns are not read.
    """
    rows = slotted(docs, id_col, text_col, slots)
    # At most one row per virtual slot reaches the driver.
    slot_map = save_map(docs.sparkSession, first_map(slot_totals(rows).collect(), shards, slots))
    return placed(rows, slot_map)
