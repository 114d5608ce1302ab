"""Sharding by fixed virtual slots.

A record's slot is a hash that never changes. A versioned map says which shard holds each slot; rebalancing writes a new
version in which as few slots as needed are moved.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placemill.staging import pin, scratch_path

SLOTS = 4096
SHARDS = 40
#: Bytes that a record needs besides its text.
OVERHEAD = 16
#: Rows by which a slot may exceed twice the mean before its rows are dealt to other slots.
SPARE = 16


class SlotMap(NamedTuple):
    """Version ``version`` of a map: the shard of each slot."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    @classmethod
    def even(cls, slots: int, shards: int) -> SlotMap:
        return cls(0, shards, tuple(slot % shards for slot in range(slots)))

    def rebalanced(self, bytes_of: list[int], shards: int | None = None) -> SlotMap:
        """The next version: ``shards`` shards (more than before: the new ones start empty; fewer: the slots of those
        that go are dealt out), and slots moved until the fullest and the emptiest differ by less than a thousandth of
        the mean, or no move or swap brings them closer."""
        shards = shards or self.shards
        held: list[list[int]] = [[] for _ in range(shards)]
        homeless = []
        for slot, shard in enumerate(self.shard_of):
            if shard < shards:
                held[shard].append(slot)
            else:
                homeless.append(slot)
        load = [sum(bytes_of[slot] for slot in slots) for slots in held]
        for slot in sorted(homeless, key=lambda slot: (-bytes_of[slot], slot)):
            _move(slot, None, min(range(shards), key=lambda shard: (load[shard], shard)), held, load, bytes_of)
        # Each step lowers the sum of squared loads, so this ends; the limit is far beyond the moves that are needed.
        for _ in range(20 * len(self.shard_of)):
            full = max(range(shards), key=lambda shard: (load[shard], -shard))
            empty = min(range(shards), key=lambda shard: (load[shard], shard))
            gap = load[full] - load[empty]
            if gap * shards * 1000 <= sum(load):
                break
            moved = _best(gap, [(slot, None) for slot in held[full]], bytes_of)
            if moved is None:
                moved = _best(gap, [(slot, other) for slot in held[full] for other in held[empty]], bytes_of)
            if moved is None:
                break
            _move(moved[0], full, empty, held, load, bytes_of)
            if moved[1] is not None:
                _move(moved[1], empty, full, held, load, bytes_of)
        shard_of = [0] * len(self.shard_of)
        for shard, slots in enumerate(held):
            for slot in slots:
                shard_of[slot] = shard
        return SlotMap(self.version + 1, shards, tuple(shard_of))


def _best(gap: int, moves: list[tuple[int, int | None]], bytes_of: list[int]) -> tuple[int, int | None] | None:
    """The move or swap that comes closest to halving the gap, if any narrows it."""
    best, left = None, gap
    for slot, other in moves:
        size = bytes_of[slot] - (0 if other is None else bytes_of[other])
        if 0 < size < gap and abs(gap - 2 * size) < left:
            best, left = (slot, other), abs(gap - 2 * size)
    return best


def _move(slot: int, source: int | None, target: int, held: list[list[int]], load: list[int], bytes_of: list[int]) -> None:
    if source is not None:
        held[source].remove(slot)
        load[source] -= bytes_of[slot]
    held[target].append(slot)
    load[target] += bytes_of[slot]


def save_map(spark: SparkSession, root: str, slot_map: SlotMap) -> None:
    """Write a version below ``root``. Writing the same version again replaces it, so a repeated run does no harm."""
    rows = [(slot, shard, slot_map.shards) for slot, shard in enumerate(slot_map.shard_of)]
    frame = spark.createDataFrame(rows, "slot int, shard int, shards int")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{root}/version={slot_map.version}")


def load_map(spark: SparkSession, root: str, version: int | None = None) -> SlotMap:
    """A stored version, by default the latest."""
    stored = spark.read.parquet(root)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.filter(F.col("version") == version).orderBy("slot").collect()
    return SlotMap(version, rows[0]["shards"], tuple(row["shard"] for row in rows))


def slot_of(columns: list[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def _held(records: DataFrame, slots: int) -> tuple[list[int], list[int]]:
    """Bytes and rows of each virtual slot."""
    bytes_of, rows_of = [0] * slots, [0] * slots
    held = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    for row in held.collect():
        bytes_of[row["virtual_slot"]], rows_of[row["virtual_slot"]] = row["bytes"], row["rows"]
    return bytes_of, rows_of


def shard_records(
    docs: DataFrame, *, shards: int = SHARDS, slots: int = SLOTS, root: str | None = None, text: str = "text"
) -> DataFrame:
    """Puts every row into a shard so that the shards' bytes are nearly equal.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text, none for null, plus ``OVERHEAD``), ``text_crc32`` (of an empty
    text for null), ``law`` (``bytes``), ``shard``, ``slot`` (the row's place in its shard, from 0 without gaps),
    ``grown_shard`` (null under this law) and ``virtual_slot``. The virtual slot follows from id, checksum and size; the
    map starts even, is edited by the bytes of the slots, and both versions are stored below ``root`` (by default a new
    folder in the shared one). Other columns are not read; an empty table gives no rows.

    Rows that agree in id, checksum and size would share a slot, however many they are. The rows of a crowded slot (more
    than twice the mean number of rows, and ``SPARE`` more) are therefore dealt to all slots by their place in the stored
    records too: number of the file's partition and row in the file, which do not change when a task is run again.

    Texts are read once and never shuffled. Each virtual slot is numbered by itself, and starts in its shard where the
    slots before it end; so no task sees a whole shard.
    """
    spark = docs.sparkSession
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    records = docs.select(
        F.col("doc_id"), (F.octet_length(raw) + OVERHEAD).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    keyed = ["doc_id", "text_crc32", "size"]
    records = pin(records.withColumn("virtual_slot", slot_of([F.col(name) for name in keyed], slots)), "records")
    bytes_of, rows_of = _held(records, slots)
    crowded = [slot for slot, rows in enumerate(rows_of) if rows * slots > 2 * sum(rows_of) + SPARE * slots]
    if crowded:
        part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
        dealt = slot_of([*(F.col(name) for name in keyed), part, F.col("_metadata.row_index")], slots)
        records = records.withColumn(
            "virtual_slot", F.when(F.col("virtual_slot").isin(crowded), dealt).otherwise(F.col("virtual_slot"))
        )
        bytes_of, rows_of = _held(records, slots)
    root = root or scratch_path(spark, "slot-map")
    first = SlotMap.even(slots, shards)
    save_map(spark, root, first)
    save_map(spark, root, first.rebalanced(bytes_of))
    current = load_map(spark, root)
    filled = [0] * shards
    places = []
    for slot, shard in enumerate(current.shard_of):
        places.append((slot, shard, filled[shard]))
        filled[shard] += rows_of[slot]
    placed = F.broadcast(spark.createDataFrame(places, "virtual_slot int, shard int, first bigint"))
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*keyed)) - 1
    return (
        records.withColumn("inside", inside)
        .join(placed, "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("inside")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
        )
    )
