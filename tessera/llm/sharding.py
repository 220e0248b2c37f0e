"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots; the bytes of each slot
are summed over the corpus (one row a slot, combined before the shuffle) and a
versioned map sends slots to shards.  The map is a table at ``store``: version 0
deals slots out in turn, and every run edits the newest version, moving single
slots from the fullest to the emptiest shard until their sizes are near equal
(slots of a removed shard are dealt out first, a new shard takes slots first),
and stores it as the next version if a slot moved.  So a run over a grown corpus moves
only the slots it must, and any older version can be read again.  Without
``store`` the map lies in the application's scratch folder.  Only the slot
counts, of fixed number, reach the driver.

A record is hashed by its id and text, so rows that repeat an id with other
texts spread over the slots.  Rows that agree in both are the same record; where
one repeats more than ``COPIES`` times its rows are dealt out by their place in the
written table, ``COPIES`` to a hash on average: no slot is made of one record.

A record's place in its shard counts from 0 without gaps: rows are numbered
inside (slot, part of the slot) and the parts' sizes are summed up, so no task
numbers a shard.  A part of a slot holds ``part_rows`` rows on average.

A null text has no bytes and is hashed as empty; a null doc_id is hashed by its
text.  Repeated rows are each placed.  An empty table gives an empty result
and leaves a stored map as it is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .common import cut

SLOTS = 4096
PART_ROWS = 100_000
COPIES = 1_000


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (bytes of the text plus 1), text_crc32, h, virtual_slot; written."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    rows = cut(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                           key.alias("key"), F.monotonically_increasing_id().alias("row")), "shard-records")
    often = rows.groupBy(F.col("key").alias("often")).agg(F.count("*").alias("n")).where(F.col("n") > COPIES)
    copy = F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / COPIES))).otherwise(0)
    rows = rows.join(often, F.col("key") == F.col("often"), "left").withColumn("h", F.xxhash64("key", copy.cast("long")))
    return cut(rows.withColumn("virtual_slot", F.pmod("h", F.lit(slots)).cast("int")).drop("key", "row", "often", "n"), "shard-rows")


def initial_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    return np.arange(slots) % shards


def rebalance(owner: np.ndarray, load: np.ndarray, shards: int, tolerance: float = 0.0005) -> np.ndarray:
    """The map after moving slots until the fullest and emptiest shard differ by
    at most ``tolerance`` of the mean, or no single move or swap helps."""
    owner = owner.copy()
    total = np.bincount(owner, load, shards)
    for _ in range(8 * len(load)):
        a, b = int(total.argmax()), int(total.argmin())
        gap = total[a] - total[b]
        if gap <= max(1.0, tolerance * total.mean()):
            break
        mine = np.flatnonzero((owner == a) & (load > 0) & (load < gap))
        if len(mine):
            s = int(mine[np.abs(load[mine] - gap / 2).argmin()])
            owner[s] = b
            total[a], total[b] = total[a] - load[s], total[b] + load[s]
            continue
        big, small = np.flatnonzero((owner == a) & (load > 0)), np.flatnonzero(owner == b)
        if not len(big) or not len(small):
            break
        diff = load[big][:, None] - load[small][None, :]
        ok = np.where((diff > 0) & (diff < gap), np.abs(diff - gap / 2), np.inf)
        i, j = np.unravel_index(int(ok.argmin()), ok.shape)
        if not np.isfinite(ok[i, j]):
            break
        owner[big[i]], owner[small[j]] = b, a
        total[a], total[b] = total[a] - diff[i, j], total[b] + diff[i, j]
    return owner


def grow(owner: np.ndarray, load: np.ndarray, shards: int) -> np.ndarray:
    """The map with one shard more, which takes slots from the fullest and gives none."""
    owner = owner.copy()
    total = np.bincount(owner, load, shards + 1)
    goal = total.sum() / (shards + 1)
    for s in np.argsort(-load, kind="stable"):
        a = owner[s]
        if total[shards] + load[s] <= goal and total[a] - load[s] >= goal * 0.98:
            owner[s], total[a], total[shards] = shards, total[a] - load[s], total[shards] + load[s]
    return owner


def shrink(owner: np.ndarray, load: np.ndarray, shards: int) -> np.ndarray:
    """The map without the shards from ``shards`` on: their slots go, largest first, to the emptiest of the others."""
    owner = owner.copy()
    stay = owner < shards
    total = np.bincount(owner[stay], load[stay], shards)
    for s in sorted(np.flatnonzero(~stay), key=lambda s: (-load[s], s)):
        owner[s] = int(total.argmin())
        total[owner[s]] += load[s]
    return owner


def edited(owner: np.ndarray, load: np.ndarray, shards: int) -> np.ndarray:
    """The next version of a map for slots of ``load`` bytes and ``shards`` shards."""
    if not load.sum():
        return owner if owner.max() < shards else shrink(owner, load, shards)
    now = int(owner.max()) + 1
    if shards < now:
        owner = shrink(owner, load, shards)
    for n in range(now, shards):
        owner = grow(owner, load, n)
    return rebalance(owner, load, shards)


def stored_map(spark: SparkSession, store: str) -> DataFrame:
    """(version, virtual_slot, shard) of every version at ``store``."""
    return spark.read.schema("virtual_slot int, shard int, version int").parquet(store)


def save_map(spark: SparkSession, store: str, version: int, owner: np.ndarray) -> None:
    """Store one version; as many rows as slots.  A version that is written again is replaced."""
    rows = spark.createDataFrame([(s, int(x)) for s, x in enumerate(owner)], "virtual_slot int, shard int")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{store}/version={version}")


def latest_map(spark: SparkSession, store: str) -> tuple[int, np.ndarray] | None:
    """The newest version and its map, None if nothing is stored yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    found = stored_map(spark, store)
    newest = found.agg(F.max("version")).first()[0]
    rows = found.where(F.col("version") == newest).collect()  # one row a slot
    owner = np.zeros(len(rows), dtype=int)
    for r in rows:
        owner[r.virtual_slot] = r.shard
    return newest, owner


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> np.ndarray:
    load = np.zeros(slots)
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("n")).collect():  # at most ``slots`` rows
        load[r.virtual_slot] = r.n
    return load


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, part_rows: int = PART_ROWS, store: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in the shard), virtual_slot, version (of the map).  A stored map
    keeps its number of slots."""
    spark = docs.sparkSession
    store = store or scratch_path(spark, "llm-shard-map")
    known = latest_map(spark, store)
    if known is None:
        known = 0, initial_map(shards, slots)
        save_map(spark, store, *known)
    version, owner = known
    rows = records(docs, len(owner))
    new = edited(owner, slot_bytes(rows, len(owner)), shards)
    if (new != owner).any():
        version += 1
        save_map(spark, store, version, new)
    latest = stored_map(spark, store).where(F.col("version") == version)
    parts = -(-rows.count() // (len(owner) * part_rows)) or 1
    rows = rows.withColumn("part", F.pmod(F.expr("shiftright(h, 16)"), F.lit(parts)).cast("int"))
    sizes = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("n")).join(F.broadcast(latest), "virtual_slot")
    starts = sizes.select("virtual_slot", "part", "shard", "version",
                          F.expr("sum(n) over (partition by shard order by virtual_slot, part) - n").alias("before"))
    numbered = rows.select("*", F.expr("row_number() over (partition by virtual_slot, part order by h, doc_id, text_crc32, size) - 1").alias("rank"))
    return numbered.join(starts, ["virtual_slot", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank")).cast("long").alias("slot"), "virtual_slot", "version")
