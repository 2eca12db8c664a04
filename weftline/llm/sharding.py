"""Sharding by jump consistent hashing (native).

A key's stable 64-bit hash seeds the published generator (multiplier 2862933555777941757,
increment 1); the key jumps through shard counts until the next jump would pass the last
one.  No ring table is kept, and one more shard takes rows only into itself.

Rows of a shard get gapless slots without bringing a shard into one task: rows are numbered
within (shard, cell) and each cell is moved by what the cells before it hold.

Defined results: null text has size ``overhead`` and the CRC of the empty text; a null key
hashes like any other value; rows that repeat a key go to its shard and get slots of their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.llm.shared import documents, materialize

MASK = 0xFFFFFFFF
MULTIPLIER = 2862933555777941757
#: Rows that one cell of a shard is meant to hold, and the most cells of a shard (bounds the table of cell offsets).
CELL_ROWS, MAX_CELLS = 20_000, 4096


def _step(key: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2**64, in 32-bit halves so that nothing overflows in ANSI mode."""
    m_high, m1, m0 = MULTIPLIER >> 32, (MULTIPLIER & MASK) >> 16, MULTIPLIER & 0xFFFF
    low, high = key.bitwiseAND(F.lit(MASK)), F.shiftrightunsigned(key, 32)
    t0, t1 = low * F.lit(m0) + F.lit(1), low * F.lit(m1)
    total = t0 + F.shiftleft(t1.bitwiseAND(F.lit(0xFFFF)), 16)
    cross = (high * F.lit(m0)).bitwiseAND(F.lit(MASK)) + F.shiftleft((high * F.lit(m1)).bitwiseAND(F.lit(0xFFFF)), 16) + (low * F.lit(m_high)).bitwiseAND(F.lit(MASK))
    top = F.shiftright(total, 32) + F.shiftright(t1, 16) + cross
    return F.shiftleft(top.bitwiseAND(F.lit(MASK)), 32).bitwiseOR(total.bitwiseAND(F.lit(MASK)))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard from 0 to ``shards - 1`` of a 64-bit key.  Each step goes up by one shard at least, so ``shards`` steps do."""

    def step(s: Column, _: Column) -> Column:
        nxt = _step(s["key"])
        to = F.floor((s["j"] + 1).cast("double") * F.lit(float(1 << 31)) / (F.shiftrightunsigned(nxt, 33) + 1).cast("double"))
        return F.when(s["j"] < shards, F.struct(s["j"].alias("b"), F.least(to, F.lit(shards).cast("long")).alias("j"), nxt.alias("key"))).otherwise(s)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), key.alias("key"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def assign_shards(rows: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, overhead: int = 8) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard: each row's place among ``shards``, and with one more."""
    raw = F.coalesce(F.col(text), F.lit(""))
    seed = F.xxhash64(F.col(key).cast("string"))
    placed = rows.select(
        F.col(key), (F.octet_length(raw) + overhead).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        jump_hash(seed, shards).alias("shard"), jump_hash(seed, shards + 1).alias("grown_shard"), F.xxhash64(seed).alias("_h"),
    )
    placed = materialize(placed, "placed")
    cells = max(1, min(MAX_CELLS, -(-placed.count() // (CELL_ROWS * shards))))
    placed = placed.withColumn("_cell", F.pmod("_h", F.lit(cells)).cast("int"))
    counts = placed.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards * MAX_CELLS rows of three numbers: a proven bound for the broadcast.
    offsets = counts.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_cell").orderBy(key, "text_crc32", "size")
    return (
        placed.withColumn("_in", F.row_number().over(within))
        .join(F.broadcast(offsets), ["shard", "_cell"])
        .select(key, "size", "text_crc32", "law", "shard", (F.col("_before") + F.col("_in") - 1).cast("long").alias("slot"), "grown_shard")
    )


def op5_jump_hash(spark, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir))
