"""Sharding over fixed virtual slots with a versioned slot-to-shard map, in DataFrame operations only."""

import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import durable, shared_folder

#: Virtual slots never change in number; shards do. A map has a row for each slot and is small enough to be sent to every task.
SLOTS, SHARDS = 8192, 16
MAP_SCHEMA = "slot int, shard int, bytes long"


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """A row (_id, _size, _crc, _key, _slot) for each row of docs, in the shared folder: texts are read and hashed once. Equal texts have one slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
        "_id", (F.octet_length("_text") + F.lit(1).cast("long")).alias("_size"), F.crc32("_text").alias("_crc"), F.xxhash64("_text").alias("_key")
    )
    return durable(rows.withColumn("_slot", F.pmod("_key", F.lit(slots)).cast("int")))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(slot, bytes, rows), summed map-side: a slot that holds a third of all rows is one row of each task."""
    return rows.groupBy(F.col("_slot").alias("slot")).agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Slots dealt to shards in turn, whatever they hold."""
    return spark.range(slots).select(F.col("id").cast("int").alias("slot"), (F.col("id") % shards).cast("int").alias("shard"), F.lit(0).cast("long").alias("bytes"))


def equal_share(sizes: DataFrame, shards: int) -> float:
    """What a shard should hold: a slot that is larger than that has a shard of its own, and the rest is shared by the others. Looks at a total and at the `shards` largest slots."""
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    for nth, r in enumerate(sizes.orderBy(F.desc("bytes"), "slot").limit(shards - 1).select("bytes").collect()):
        if r["bytes"] * (shards - nth) <= total:
            return total / (shards - nth)
        total -= r["bytes"]
    return float(total)


def rebalanced(current: DataFrame, sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The map edited for these sizes (slot, bytes) and this number of shards; it may grow or shrink.

    A shard keeps its largest slots as long as they fit into an equal share (see equal_share), its first in any case, and empty ones. All others go, largest first
    (ties to the smaller slot), each to the shard with least bytes then, the smallest of equals. So a shard exceeds the
    equal share by less than the slot that it was dealt last, unless a single slot does. Slots of shards that are gone are dealt out again; a new shard only receives. The edit is one
    row of as many slots as move: 8,192 at most, however many documents there are.
    """
    by_size = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    now = current.select("slot", "shard").join(sizes.select("slot", "bytes"), "slot", "left").select("slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    fits = (F.sum("bytes").over(by_size.rowsBetween(Window.unboundedPreceding, 0)) <= equal_share(sizes, shards)) | (F.row_number().over(by_size) == 1) | (F.col("bytes") == 0)
    told = durable(now.withColumn("stays", fits & (F.col("shard") < shards)))
    stays = told.filter("stays").select("slot", "shard", "bytes")
    loads = sizes.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(stays.groupBy("shard").agg(F.sum("bytes").alias("load")), "shard", "left")
    load = F.struct("shard", F.coalesce("load", F.lit(0)).alias("load"))
    move = F.struct((-F.col("bytes")).alias("less"), "slot")
    both = loads.select(load.alias("l")).unionByName(told.filter("not stays").select(move.alias("g")), allowMissingColumns=True)
    one_row = both.agg(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["load"]).alias("loads"), F.array_sort(F.collect_list("g")).alias("gone"))
    least = lambda acc: F.array_position(acc["loads"], F.array_min(acc["loads"]))
    deal = F.aggregate(
        F.col("gone"),
        F.struct(F.col("loads"), F.expr("cast(array() as array<int>)").alias("to")),
        lambda acc, x: F.struct(
            F.transform(acc["loads"], lambda v, k: v - F.when(k + 1 == least(acc), x["less"]).otherwise(F.lit(0))).alias("loads"),
            F.concat(acc["to"], F.array((least(acc) - 1).cast("int"))).alias("to"),
        ),
    )
    moved = one_row.select(F.explode(F.arrays_zip("gone", deal["to"].alias("to"))).alias("m")).select("m.gone.slot", F.col("m.to").alias("shard"), (-F.col("m.gone.less")).alias("bytes"))
    return stays.unionByName(moved)


def save_map(slot_map: DataFrame, folder: str) -> int:
    """Stores the map as the next version below the folder, beside those before, and returns its number (from 1). A version is never changed. One writer at a time."""
    version = max(versions(slot_map.sparkSession, folder), default=0) + 1
    slot_map.select("slot", "shard", "bytes").coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")
    return version


def versions(spark: SparkSession, folder: str) -> list[int]:
    try:
        return sorted(r[0] for r in spark.read.schema(f"{MAP_SCHEMA}, version int").parquet(folder).select("version").distinct().collect())
    except AnalysisException:  # nothing stored there yet
        return []


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The map of that version, the latest by default, with its version."""
    number = versions(spark, folder)[-1] if version is None else version
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={number}").withColumn("version", F.lit(number))


def placed(rows: DataFrame, slot_map: DataFrame, count: int) -> DataFrame:
    """Adds _shard and _place, the row's number in its shard from 0 without gaps. Rows of a shard are numbered by pseudorandom parts, as many as the
    root of their count, so neither a shard nor a group of copies meets in one task; then parts are moved on by what lies before."""
    part = F.pmod(F.xxhash64("_id", "_key", F.lit(7)), F.lit(max(1, math.isqrt(count))))
    dealt = rows.join(F.broadcast(slot_map.select(F.col("slot").alias("_slot"), F.col("shard").alias("_shard"), "version")), "_slot").withColumn("_part", part)
    before = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_shard", "_part").agg(F.count(F.lit(1)).alias("_n")).select("_shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_shard", "_part").orderBy("_id", "_key")
    return dealt.withColumn("_nth", F.row_number().over(inside)).join(starts, ["_shard", "_part"]).withColumn("_place", F.col("_start") + F.col("_nth") - 1)


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version).

    The law is `bytes`: shards come near to equal sizes, size being a text's UTF-8 bytes plus one. Texts are hashed to `slots` fixed virtual slots and
    bytes are summed by slot. The folder's latest slot-to-shard map (or, in an empty folder, one that deals slots in turn, stored as version 1) is edited
    for these bytes and stored as the next version: only what exceeds an equal share moves. `slot` is a row's place in its shard, from 0 without gaps.
    Without a folder, the map has one of its own in the shared folder.

    Equal texts share a slot and so a shard, even a group that alone exceeds an equal share; all other shards then stay near to equal. No task
    handles such a group: slots are summed map-side and places are given by parts. A null text counts as empty, of size 1. Texts of any length are only hashed. Rows that repeat
    have a place each. Null ids have places too. Extra columns are ignored, whatever they are called. An empty table gives no rows. grown_shard is null, as a shard depends on sizes and not on the id alone.
    """
    if slots < shards:
        raise ValueError(f"{slots} slots are fewer than {shards} shards")
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/shard-map-{uuid.uuid4().hex}"
    rows = measured(docs, id_col, text_col, slots)
    sizes = durable(slot_sizes(rows))
    if not versions(spark, folder):
        save_map(first_map(spark, shards, slots), folder)
    save_map(rebalanced(load_map(spark, folder), sizes, shards), folder)
    count = sizes.agg(F.sum("rows")).first()[0] or 0
    return placed(rows, load_map(spark, folder), count).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_place").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_slot").alias("virtual_slot"),
        F.col("version").alias("map_version"),
    )
