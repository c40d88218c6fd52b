"""Sharding over fixed virtual slots.

Records are hashed by id and text into a fixed number of virtual slots, so
rows that share an id, or have none, spread like any others. Bytes are
summed per slot, and a slot-to-shard map, one row per slot, decides the shard.
Every map is stored as a new version; rebalancing edits the last version, so
only the slots that leave an overfull shard (or fill a new one) move.

The law is ``bytes``: shard sizes are near equal. Slots are placed largest
first on the least loaded shard, as a fold over the array of slot sizes
(``n_slots`` entries, whatever the size of the data).

Defined cases: NULL text counts as the empty text; rows of one id, or without
an id, are dealt by their texts; repeated rows (id and text alike) share a slot
and each get a place of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.session import work_path

N_SHARDS = 40
N_SLOTS = 8192
ROW_OVERHEAD = 16
# A shard may exceed the mean by this share before an edit moves its slots.
TOLERANCE = 0.02


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row (no shuffle)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(n_slots)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(recs: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot: at most ``n_slots`` rows."""
    return recs.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"),
                                            F.count(F.lit(1)).alias("slot_rows"))


def _place(loads: Column, slots: Column) -> Column:
    """Fold sorted (-bytes, slot) pairs onto the least loaded shard each."""
    zero = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("shards"))

    def step(acc: Column, s: Column) -> Column:
        pick = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda x, i: F.when(i == pick, x - s["neg"]).otherwise(x))
            .alias("loads"),
            F.concat(acc["shards"], F.array(pick)).alias("shards"),
        )

    return F.transform(
        F.aggregate(slots, zero, step, lambda acc: acc["shards"]),
        lambda shard, i: F.struct(F.get(slots, i)["virtual_slot"].alias("virtual_slot"),
                                  shard.alias("shard")),
    )


def _placed(free: DataFrame, loads: DataFrame | None, n_shards: int) -> DataFrame:
    """Place ``free`` slots (virtual_slot, slot_bytes) on top of given loads."""
    slots = free.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("slot_bytes")).alias("neg"), "virtual_slot"))).alias("slots"))
    if loads is None:
        slots = slots.withColumn("loads", F.array_repeat(F.lit(0).cast("bigint"), n_shards))
    else:
        given = loads.agg(F.map_from_entries(F.collect_list(F.struct("shard", "load"))).alias("m"))
        start = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                            lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0)).cast("bigint"))
        slots = slots.withColumn("one", F.lit(1)).join(
            given.select(start.alias("loads"), F.lit(1).alias("one")), "one")
    return slots.select(F.explode(_place(F.col("loads"), F.col("slots"))).alias("p")).select("p.*")


def new_map(sizes: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """First slot-to-shard map: (virtual_slot, shard)."""
    return _placed(sizes.select("virtual_slot", "slot_bytes"), None, n_shards)


def edit_map(old: DataFrame, sizes: DataFrame, n_shards: int,
             tolerance: float = TOLERANCE) -> DataFrame:
    """Edit a map for new sizes or more shards; slots that can stay do.

    A shard within the fair share plus the tolerance keeps its slots. A
    fuller one keeps them, largest first, while their running total is within
    the fair share (its largest slot always stays). The others, slots of
    dropped shards and slots unknown to the old map are placed on the least
    loaded shards.
    """
    mean = sizes.agg((F.sum("slot_bytes") / n_shards).alias("fair"))
    run = Window.partitionBy("shard").orderBy(F.col("slot_bytes").desc(), "virtual_slot")
    now = (sizes.join(old.select("virtual_slot", "shard"), "virtual_slot", "left")
           .withColumn("one", F.lit(1)).join(mean.withColumn("one", F.lit(1)), "one")
           .withColumn("total", F.sum("slot_bytes").over(run))
           .withColumn("whole", F.sum("slot_bytes").over(Window.partitionBy("shard")))
           .withColumn("nth", F.row_number().over(run))
           .withColumn("stays", F.coalesce((F.col("shard") < n_shards) & (
               (F.col("whole") <= F.col("fair") * (1 + tolerance)) | (F.col("total") <= F.col("fair"))
               | (F.col("nth") == 1)), F.lit(False))))
    kept = now.filter("stays").select("virtual_slot", "shard")
    loads = now.filter("stays").groupBy("shard").agg(F.sum("slot_bytes").alias("load"))
    moved = _placed(now.filter("NOT stays").select("virtual_slot", "slot_bytes"), loads, n_shards)
    return kept.unionByName(moved)


def store_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Write one version; an existing version is never overwritten."""
    slot_map.withColumn("version", F.lit(version)).coalesce(1).write.parquet(f"{path}/map-{version:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/map-{version:06d}")


def assign(recs: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """Shard and place within the shard (gapless from 0) of every record.

    A place is the rows of the shard's earlier slots plus the rank inside the
    record's own slot, so no task ever sorts a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    plan = (sizes.join(slot_map.select("virtual_slot", "shard"), "virtual_slot")
            .select("virtual_slot", "shard", F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("first")))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    # the plan has one row per virtual slot, a fixed bound: safe to broadcast
    return recs.withColumn("rank", rank).join(F.broadcast(plan), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("rank") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def shard(spark: SparkSession, docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS,
          map_path: str | None = None) -> DataFrame:
    """Shard every row of ``docs`` by a first map stored under ``map_path``."""
    recs = records(docs, n_slots=n_slots)
    sizes = slot_sizes(recs)
    path = map_path or work_path(spark, "shard-maps", uuid.uuid4().hex)
    store_map(new_map(sizes, n_shards), path, 1)
    return assign(recs, load_map(spark, path, 1), sizes)
