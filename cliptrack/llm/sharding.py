"""Shards through fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cliptrack.llm.shared import shared_folder, written

#: Virtual slots; fixed for the life of a data set.
SLOTS = 4096
#: Parts of a slot in which records are numbered, by their place in the input, so that
#: one key that many records carry, or one record repeated, is numbered by many tasks.
PARTS = 64


def with_slots(records: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """Add virtual_slot, the key's hash modulo the slots. A null key has a slot too."""
    return records.withColumn(
        "virtual_slot", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(slots)).cast("int")
    )


def slot_sizes(slotted: DataFrame, size: str = "size") -> DataFrame:
    """(virtual_slot, records, bytes) of the slots in use; at most one row a slot."""
    return slotted.groupBy("virtual_slot").agg(
        F.count("*").alias("records"), F.sum(size).alias("bytes")
    )


def first_map(spark, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map (version, virtual_slot, shard): slots dealt in turn.

    The map has one row a slot, so its size is fixed by `slots`.
    """
    dealt = spark.range(slots).select(
        F.lit(1).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % shards).cast("int").alias("shard"),
    )
    return dealt.coalesce(1)


def store_map(slot_map: DataFrame, folder: str) -> DataFrame:
    """Write a version of the map to a folder of versions, and give all that are there.

    A version that is there already is an error: versions never change.
    """
    now = written(latest(slot_map).coalesce(1))
    version = now.select("version").first()[0]
    now.select("virtual_slot", "shard").write.parquet(f"{folder}/version={version}")
    return stored_map(slot_map.sparkSession, folder)


def stored_map(spark: SparkSession, folder: str) -> DataFrame:
    """All versions of the map in a folder, SLOTS rows each."""
    return spark.read.schema("version int, virtual_slot int, shard int").parquet(folder)


def latest(slot_map: DataFrame) -> DataFrame:
    """The rows of the newest version."""
    newest = slot_map.agg(F.max("version").alias("version"))
    return slot_map.join(F.broadcast(newest), "version")


def grown(slot_map: DataFrame) -> DataFrame:
    """The next version, with one more shard, which alone takes slots.

    Every old shard gives its share, chosen by the slot's own hash, so that the
    result follows from the map and the number of shards and from no data.
    """
    now = latest(slot_map)
    count = now.agg((F.max("shard") + 1).alias("shards"))
    turn = Window.partitionBy("shard").orderBy(F.xxhash64("virtual_slot"), "virtual_slot")
    ranked = now.join(F.broadcast(count), how="cross").select(
        "*",
        F.row_number().over(turn).alias("turn"),
        F.count("*").over(Window.partitionBy("shard")).alias("held"),
    )
    return ranked.select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.expr("cast(if(turn <= held div (shards + 1), shards, shard) as int)").alias("shard"),
    )


def rebalanced(slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """The next version, in which shards over the mean give slots to those under it.

    Over the bytes of each slot: a shard keeps its slots, in slot order, as far as
    they fit the mean; the others are laid end to end along the room that is left
    in the shards below the mean. All of it is work on one row a slot.
    """
    now = latest(slot_map).join(sizes, "virtual_slot", "left").fillna(0, ["bytes"])
    shards = now.groupBy("shard").agg(F.sum("bytes").alias("load"))
    mean = shards.agg((F.sum("load") / F.count("*")).alias("mean"))
    upto = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = now.withColumn("upto", F.sum("bytes").over(upto)).crossJoin(F.broadcast(mean))
    stays = placed.where("upto <= mean or bytes = 0")
    kept = stays.groupBy("shard").agg(F.sum("bytes").alias("kept"))
    line = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = (
        shards.join(kept, "shard", "left")
        .crossJoin(F.broadcast(mean))
        .withColumn("room", F.greatest(F.col("mean") - F.coalesce("kept", F.lit(0)), F.lit(0.0)))
        .withColumn("until", F.sum("room").over(line))
        .select("shard", (F.col("until") - F.col("room")).alias("since"), "until")
    )
    queue = Window.orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    moves = placed.where("upto > mean and bytes > 0").withColumn(
        "middle", F.sum("bytes").over(queue) - F.col("bytes") / 2
    )
    target = moves.select("version", "virtual_slot", "middle", F.col("shard").alias("old")).join(
        F.broadcast(room), F.expr("middle >= since and middle < until"), "left"
    )
    moved = target.select(
        "version", "virtual_slot", F.coalesce("shard", "old").alias("shard")
    )
    return stays.select("version", "virtual_slot", "shard").unionByName(moved).withColumn(
        "version", F.col("version") + 1
    )


def slim(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot and part of every record, written down.

    Null text: size 1, checksum of nothing. A very long text is one number too.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place.alias("part"),
    )
    return written(with_slots(rows, "doc_id"))


def sharded(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every slim record with its shard and place in the shard.

    A record's shard is its slot's in the newest version of the map, so the record's
    key and the map decide alone. Its place (slot, from 0, without gaps) is what the
    earlier parts of the shard hold plus its rank within its own part. Equal records are
    numbered in any order.
    """
    # One row a slot and part at most: SLOTS * PARTS rows, whatever the input.
    counts = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("records"))
    before = (
        Window.partitionBy("shard")
        .orderBy("virtual_slot", "part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    places = counts.join(F.broadcast(latest(slot_map)), "virtual_slot").select(
        "virtual_slot",
        "part",
        "shard",
        F.coalesce(F.sum("records").over(before), F.lit(0)).alias("offset"),
    )
    rank = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("rank", F.row_number().over(rank))
        .join(F.broadcast(places), ["virtual_slot", "part"])
        .withColumn("slot", (F.col("offset") + F.col("rank") - 1).cast("long"))
        .drop("rank", "offset", "part")
    )


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15, and where they go with a seventeenth.

    The map's versions are kept in the shared folder and read from there: 1 for the sixteen
    shards, 2 grown by one, 3 the first rebalanced by the bytes of its slots. By law `key`
    the documents lie by version 1; the bytes of their slot and their shard in version 3
    come as further columns.
    """
    rows = slim(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    folder = f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    first = store_map(first_map(spark, 16), folder)
    sizes = written(slot_sizes(rows).coalesce(1))
    store_map(grown(first), folder)
    even = rebalanced(first.where("version = 1"), sizes).withColumn("version", F.lit(3))
    versions = store_map(even, folder)
    at = {n: versions.where(F.col("version") == n) for n in (1, 2, 3)}
    # SLOTS rows each.
    facts = (
        at[2].select("virtual_slot", F.col("shard").alias("grown_shard"))
        .join(at[3].select("virtual_slot", F.col("shard").alias("even_shard")), "virtual_slot")
        .join(sizes.select("virtual_slot", F.col("bytes").alias("slot_bytes")), "virtual_slot")
    )
    return (
        sharded(rows, at[1])
        .join(F.broadcast(facts), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            "slot",
            "grown_shard",
            "virtual_slot",
            "slot_bytes",
            "even_shard",
        )
    )
