"""Sharding over fixed virtual slots.

Records hash into a fixed number of slots (thousands), the bytes of each slot are summed, and a
versioned table maps slots to shards.  The map is the only thing that rebalancing edits: a record
never changes its slot, and a slot only leaves its shard when that shard has bytes over its share.  A saved map starts a run where the last
one ended; versions are never rewritten.  Only DataFrame functions are used.

Edge cases: a null text has no bytes (the fixed overhead stays); a null key hashes by its text
alone; equal (key, text) records share a slot; an empty table gives an empty result; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize, salted_row_number
from sparkqa.session import scratch_path

SLOTS = 8192


def records(df: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS, overhead: int = 16) -> DataFrame:
    """One narrow row a record: key, size (UTF-8 bytes + ``overhead``), text_crc32, virtual_slot."""
    return df.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.encode(F.col(text), "utf-8")), F.lit(0)).alias("text_crc32"),
        F.pmod(F.xxhash64(key, text), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_bytes(recs: DataFrame) -> DataFrame:
    """``virtual_slot, rows, bytes``: at most one row a slot, whatever the input."""
    return recs.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 0: slot modulo shards, before any sizes are looked at."""
    return sizes.select(F.lit(0).alias("version"), "virtual_slot", "rows", "bytes",
                        F.pmod("virtual_slot", F.lit(shards)).cast("int").alias("shard"))


def rebalance(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version of the map: slots move, the largest first, from shards with more than their equal share of the bytes to the
    shard with the fewest, as long as the shard they leave keeps its share.  So no more bytes move than were over, and all other
    slots stay.

    The map has at most one row a slot (thousands, fixed), so it is folded as one array.
    """
    spec = F.struct(F.col("bytes"), F.col("virtual_slot"), F.col("rows"), F.col("version"), F.col("shard"))
    one = slot_map.groupBy().agg(F.sort_array(F.collect_list(spec), asc=False).alias("s"))
    # bytes of shard i, with i, as the map has them
    load = F.array(*[F.struct(F.aggregate(F.filter("s", lambda x: x["shard"] == i), F.lit(0).cast("bigint"), lambda a, x: a + x["bytes"]).alias("bytes"),
                              F.lit(i).alias("shard")) for i in range(shards)])
    start = F.struct(F.col("load"), F.array().cast("array<int>").alias("to"))

    def step(acc, x):
        least, own = F.array_min(acc["load"]), F.element_at(acc["load"], x["shard"] + 1)["bytes"]
        left = own - x["bytes"]
        go = (left >= F.col("share")) & (least["bytes"] + x["bytes"] <= F.greatest(left, F.col("share"))) & (x["bytes"] > 0)
        moved = F.transform(acc["load"], lambda y: F.struct(
            F.when(y["shard"] == least["shard"], y["bytes"] + x["bytes"]).when(y["shard"] == x["shard"], y["bytes"] - x["bytes"]).otherwise(y["bytes"]).alias("bytes"),
            y["shard"].alias("shard")))
        return F.struct(F.when(go, moved).otherwise(acc["load"]).alias("load"),
                        F.concat(acc["to"], F.array(F.when(go, least["shard"]).otherwise(x["shard"]))).alias("to"))

    share = F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + x["bytes"]) / F.lit(float(shards))
    done = one.withColumn("load", load).withColumn("share", share).select("s", F.aggregate("s", start, step, lambda a: a["to"]).alias("to"))
    return done.select(F.posexplode("s").alias("i", "x"), "to").select(
        (F.col("x.version") + 1).alias("version"), F.col("x.virtual_slot").alias("virtual_slot"),
        F.col("x.rows").alias("rows"), F.col("x.bytes").alias("bytes"), F.element_at("to", F.col("i") + 1).alias("shard"))


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version with one more shard: whole slots move into it, in slot order, until it holds
    its equal share of the bytes; no slot moves between old shards."""
    total = slot_map.agg(F.sum("bytes").alias("all_bytes"))
    w = Window.partitionBy("shard").orderBy(F.xxhash64("virtual_slot"), "virtual_slot")
    per = Window.partitionBy("shard")
    run = slot_map.join(F.broadcast(total)) \
        .withColumn("_before", F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_own", F.sum("bytes").over(per))
    give = F.col("_before") <= F.col("_own") - F.col("all_bytes") / F.lit(float(shards + 1))
    return run.select((F.col("version") + 1).alias("version"), "virtual_slot", "rows", "bytes",
                      F.when(give, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Slots whose shard differs between two versions: what a rebalancing copies."""
    o = old.select("virtual_slot", F.col("shard").alias("old_shard"))
    return new.join(F.broadcast(o), "virtual_slot").filter("shard != old_shard") \
        .select("version", "virtual_slot", "old_shard", "shard", "rows", "bytes")


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Write one version; every version stays readable, and one that is there is an error."""
    slot_map.drop("version").write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark, path: str, version: int | None = None) -> DataFrame | None:
    """The given version of a saved map, or its newest; None where nothing is saved."""
    from pyspark.errors import AnalysisException
    try:
        m = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if version is None:
        version = m.agg(F.max("version")).first()[0]
    return m.filter(F.col("version") == version).select("version", "virtual_slot", "rows", "bytes", "shard")


def with_sizes(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The map with present ``sizes`` of slots; slots that it has not are dealt in turn.  Both have at most one row a slot."""
    old = slot_map.select("virtual_slot", "version", "shard")
    newest = old.agg(F.max("version").alias("newest"))
    d = old.join(sizes, "virtual_slot", "full").join(F.broadcast(newest))
    return d.select(F.coalesce("newest", F.lit(0)).alias("version"), "virtual_slot", F.coalesce("rows", F.lit(0)).alias("rows"),
                    F.coalesce("bytes", F.lit(0)).alias("bytes"), F.coalesce("shard", F.pmod("virtual_slot", F.lit(shards))).cast("int").alias("shard"))


def place(recs: DataFrame, slot_map: DataFrame, key: str = "doc_id", number: str = "_row") -> DataFrame:
    """Each record's shard and its place there (``slot``: from 0, without gaps).  ``number`` tells equal records apart.

    The place is the rows of the shard's earlier virtual slots plus the number inside the virtual
    slot, so a shard is numbered by all tasks that hold its slots.
    """
    w = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offs = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("_before"))
    numbered = salted_row_number(recs, ["virtual_slot"], [key, "text_crc32", "size", number], number, "_in", salts=16)
    return numbered.join(F.broadcast(offs), "virtual_slot") \
        .withColumn("slot", (F.col("_before") + F.col("_in")).cast("bigint")).drop("_before", "_in", number)


def current_map(sizes: DataFrame, shards: int, map_path: str) -> DataFrame:
    """The map for slots of these ``sizes``: the newest one saved at ``map_path`` (the first deals slots in turn), edited and saved as
    the next version where that moves a slot or a slot is new."""
    spark = sizes.sparkSession
    last = load_map(spark, map_path)
    if last is None:
        last = first_map(sizes, shards)
        save_map(last, map_path, 0)
    now = materialize(with_sizes(last, sizes, shards), "slot-sizes")
    edited = materialize(rebalance(now, shards), "slot-map")
    known = last.select("virtual_slot", F.col("shard").alias("old_shard"))
    differs = edited.join(F.broadcast(known), "virtual_slot", "left").filter("old_shard is null or old_shard != shard")
    if differs.isEmpty():
        return edited
    version = edited.agg(F.max("version")).first()[0]
    save_map(edited, map_path, version)
    return load_map(spark, map_path, version)


def shard(df: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", slots: int = SLOTS,
          map_path: str | None = None) -> DataFrame:
    """Records with ``shard`` in 0..shards-1 and nearly equal bytes a shard.

    The map is kept at ``map_path`` (a folder of this run's own without one): a run on the same records finds it balanced and
    changes nothing, one on other records moves what is over.
    """
    recs = materialize(records(df, key, text, slots).withColumn("_row", F.monotonically_increasing_id()), "shard-records")
    sizes = materialize(slot_bytes(recs), "slot-bytes")
    return place(recs, current_map(sizes, shards, map_path or scratch_path(df.sparkSession, "slot-maps")), key)
