"""Sharding through fixed virtual slots.

A record's virtual slot is a hash of its id and text into a few thousand slots
and never changes. Bytes are summed per slot; a stored, versioned map says which
shard each slot is in. Rebalancing edits the map and moves whole slots only: a call
with a folder that holds a map edits its latest version and stores the next one.

Copies of a text are spread like other records, which keeps the bytes of shards near
equal even where a third of all rows are copies; this method keeps no groups together.

Defined results: a null text has 0 bytes, and the checksum of an empty one; a
null id is hashed like any other value; repeated rows share a slot; an empty
table gives no rows, its map spreads the slots evenly. Other columns of the
input are not read.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickstrata.llm.common import text_of
from clickstrata.session import path_exists, working_dir

VIRTUAL_SLOTS = 8192
ROW_OVERHEAD = 16


def sized(docs: DataFrame, virtual_slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """doc_id, size in bytes, checksum of the text and virtual slot of each row."""
    text = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn(
        "virtual_slot",
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(virtual_slots)).cast("int"),
    )


def slot_loads(records: DataFrame, virtual_slots: int = VIRTUAL_SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) of each virtual slot: as many pairs as there are slots, whatever the data."""
    loads = [(0, 0)] * virtual_slots
    sums = records.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1)))
    for slot, size, rows in sums.collect():
        loads[slot] = (size, rows)
    return loads


def first_map(sizes: list[int], shards: int) -> list[int]:
    """Shard of each slot: the largest slot left goes to the lightest shard."""
    load = [(0, shard) for shard in range(shards)]
    placed = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        # An empty slot still counts a little, so that a later fill is spread.
        carried, shard = heapq.heappop(load)
        placed[slot] = shard
        heapq.heappush(load, (carried + max(sizes[slot], 1), shard))
    return placed


def rebalanced(current: list[int], sizes: list[int], shards: int, slack: float = 0.01) -> list[int]:
    """An edit of the map for new sizes or more shards: few slots move, from heavy to light.

    Slots leave the heaviest shard for the lightest until no move narrows the
    gap or all shards are within ``slack`` of the mean. Only moved slots change. With
    shards the map does not know yet, slots move into these only.
    """
    edited = list(current)
    known = max(current, default=-1) + 1
    into = range(known, shards) if known < shards else range(shards)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(edited):
        held[shard].append((max(sizes[slot], 1), slot))
    load = [sum(size for size, _ in own) for own in held]
    mean = sum(load) / shards
    for _ in range(len(sizes)):
        light = min(into, key=lambda s: (load[s], s))
        by_load = sorted(range(shards), key=lambda s: (-load[s], s))
        even = known < shards or load[by_load[0]] <= mean * (1 + slack)
        if even and load[light] >= mean * (1 - slack):
            break
        # The heaviest shard that has a slot whose move narrows the gap.
        for heavy in by_load:
            gap = load[heavy] - load[light]
            fits = [entry for entry in held[heavy] if entry[0] < gap]
            if fits:
                break
        else:
            break
        wanted = min(load[heavy] - mean, mean - load[light])
        size, slot = min(fits, key=lambda entry: (abs(entry[0] - max(wanted, 1)), entry[1]))
        held[heavy].remove((size, slot))
        held[light].append((size, slot))
        load[heavy] -= size
        load[light] += size
        edited[slot] = light
    return edited


def map_frame(
    spark: SparkSession, placed: list[int], rows: list[int], version: int = 1
) -> DataFrame:
    """The map as a table, with the place in its shard where each slot's rows begin."""
    filled: dict[int, int] = {}
    first = []
    for slot, shard in enumerate(placed):
        first.append(filled.get(shard, 0))
        filled[shard] = first[-1] + rows[slot]
    shard_of = F.from_json(F.lit(json.dumps(placed)), "array<int>")
    first_of = F.from_json(F.lit(json.dumps(first)), "array<bigint>")
    return (
        spark.range(1)
        .select(F.posexplode(F.arrays_zip(shard_of.alias("shard"), first_of.alias("first"))))
        .select(
            F.lit(version).alias("version"),
            F.col("pos").alias("virtual_slot"),
            F.col("col.shard").alias("shard"),
            F.col("col.first").alias("first_place"),
        )
    )


def store_map(slot_map: DataFrame, folder: str) -> None:
    """Add a version to the stored map; earlier versions stay, and are not written again."""
    version = slot_map.first()["version"]
    place = f"{folder}/version={version}"
    slot_map.coalesce(1).drop("version").write.mode("errorifexists").parquet(place)


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of the stored map, the latest by default."""
    schema = "virtual_slot int, shard int, first_place bigint, version int"
    maps = spark.read.schema(schema).parquet(folder)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version)


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record's shard, and its place there, numbered from 0 without gaps.

    Rows are numbered within their virtual slot, so no task sorts a whole shard.
    The map is broadcast: it has one short row per slot.
    """
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32")
    return (
        records.withColumn("in_slot", F.row_number().over(order) - 1)
        .join(F.broadcast(slot_map.drop("version")), "virtual_slot")
        .select(
            *records.columns,
            "shard",
            (F.col("first_place") + F.col("in_slot")).cast("long").alias("slot"),
        )
    )


def shard(docs: DataFrame, shards: int, folder: str | None = None) -> DataFrame:
    """Deal the documents out by the next version of the map in ``folder``, the first if it has none.

    The next version is an edit of the latest for the documents' sizes and the number of
    shards, which may have grown. Fewer shards than the map has are refused.
    """
    spark = docs.sparkSession
    records = sized(docs)
    loads = slot_loads(records)
    sizes, rows = [size for size, _ in loads], [count for _, count in loads]
    folder = folder or working_dir(spark, "slot_map")
    version, placed = 1, None
    if path_exists(spark, folder):
        latest = read_map(spark, folder).orderBy("virtual_slot").collect()
        version, current = latest[0]["version"] + 1, [row["shard"] for row in latest]
        if max(current) >= shards:
            raise ValueError(f"the map in {folder} has more than {shards} shards")
        placed = rebalanced(current, sizes, shards)
    if placed is None:
        placed = first_map(sizes, shards)
    store_map(map_frame(spark, placed, rows, version), folder)
    return place(records, read_map(spark, folder, version))
