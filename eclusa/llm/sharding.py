"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, thousands of them; the bytes of each
slot are summed; a versioned table maps slots to shards. Rebalancing, or one more
shard, edits that table and moves whole slots; records are never hashed anew.

Slots are dealt out largest first, each to the shard with the fewest bytes so far,
ties to the smaller shard. Only the slot table, whose size is the number of slots,
is ever held in one place.

The hash covers the id and the text's checksum, so rows with one id and different
texts part, and copies of one text under different ids spread over all slots. Only rows
that are equal in both share a slot; its bytes are then more, and the deal evens out the
rest. A null id counts as an empty one, a null text as no bytes. An empty table gives an
empty map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eclusa.llm.frames import staged

SLOTS = 8192
# Bytes that a record has besides its text.
ROW_BYTES = 16


def sized(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``virtual_slot`` of each record."""
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )


def with_slot(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32")
    head = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")
    return records.withColumn("virtual_slot", (head % slots).cast("int"))


def _dealt(slots: Column, loads: Column, shards: int) -> Column:
    """Slots (bytes and number, largest first) appended one by one to the emptiest shard."""

    def place(acc: Column, slot: Column) -> Column:
        to = F.array_position(acc.loads, F.array_min(acc.loads)).cast("int") - 1
        grown = F.transform(
            acc.loads, lambda load, i: F.when(i == to, load + slot["n_bytes"]).otherwise(load)
        )
        return F.struct(grown.alias("loads"), F.concat(acc.to, F.array(to)).alias("to"))

    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("to"))
    return F.aggregate(slots, start, place, lambda acc: acc.to)


def slot_map(slot_bytes: DataFrame, shards: int) -> DataFrame:
    """First version of the map: ``version``, ``virtual_slot``, ``shard``, ``n_bytes``.

    ``slot_bytes`` has ``virtual_slot`` and ``n_bytes`` of each slot that has records.
    """
    # Negative bytes first: the largest slots lead, ties by number.
    order = F.array_sort(F.collect_list(F.struct((-F.col("n_bytes")).alias("less"), "virtual_slot")))
    all_slots = F.transform(
        order, lambda s: F.struct((-s.less).alias("n_bytes"), s.virtual_slot.alias("virtual_slot"))
    )
    loads = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda _: F.lit(0).cast("long"))
    one = slot_bytes.agg(all_slots.alias("slots"))
    dealt = one.select("slots", _dealt(F.col("slots"), loads, shards).alias("to"))
    return dealt.select(F.explode(F.arrays_zip("slots", "to")).alias("z")).select(
        F.lit(1).alias("version"),
        F.col("z.slots.virtual_slot").alias("virtual_slot"),
        F.col("z.to").alias("shard"),
        F.col("z.slots.n_bytes").alias("n_bytes"),
    )


def grown_map(current: DataFrame, shards: int) -> DataFrame:
    """The next version of a map of ``shards`` shards, edited for one shard more.

    Each old shard gives up its smallest slots until it would fall below an even
    share; they go to the new shard, and no slot moves between old shards.
    """
    share = F.sum("n_bytes").over(Window.partitionBy()) / (shards + 1)
    own = Window.partitionBy("shard")
    passed = F.sum("n_bytes").over(
        own.orderBy("n_bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    left = F.sum("n_bytes").over(own) - passed
    return current.withColumns({"share": share, "left": left}).select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.when(F.col("left") >= F.col("share"), F.lit(shards)).otherwise(F.col("shard")).alias("shard"),
        "n_bytes",
    )


def assign(records: DataFrame, the_map: DataFrame) -> DataFrame:
    """Records with ``shard`` and ``slot``, their place in the shard from 0 on.

    Places are numbered within each virtual slot and set off by the records of the
    shard's slots before it, so no task holds a shard.
    """
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32"))
    counts = records.groupBy("virtual_slot").agg(F.count("*").alias("n_rows"))
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = the_map.join(F.broadcast(counts), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("start")
    )
    # One row for each virtual slot: its size is bounded by their number.
    return (
        records.withColumn("place", place)
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", F.col("place") - 1 + F.col("start"))
        .drop("place", "start")
    )


def shard(documents: DataFrame, shards: int, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Records with their shards, and the slot map by which they were dealt."""
    records = staged(with_slot(sized(documents), slots), "shard-records")
    slot_bytes = records.groupBy("virtual_slot").agg(F.sum("size").alias("n_bytes"))
    the_map = staged(slot_map(slot_bytes, shards), "shard-map")
    return assign(records, the_map), the_map
