"""Sharding by jump consistent hashing (Lamping and Veach, 2014), DataFrame functions only.

A row's shard depends on its key and the number of shards alone: no ring table, no
state. Appending one shard moves rows only into the new shard, about 1/(n+1) of them.

Each step of the jump function advances a 64-bit linear congruential generator. SQL longs
are signed and checked for overflow, so the generator's state is kept as two 32-bit halves
and multiplied piecewise; every intermediate stays below 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from svcvitals.llm.columns import pick, utf8
from svcvitals.sources.tables import materialize

#: The generator's multiplier, as published with the jump function (fixed value).
LCG = 2862933555777941757
_LO, _HI = LCG & 0xFFFFFFFF, LCG >> 32
_M32, _M16 = (1 << 32) - 1, (1 << 16) - 1


def _and(c: Column, mask: int) -> Column:
    return c.bitwiseAND(F.lit(mask).cast("long"))


def _step(s: Column, n: int) -> Column:
    """One jump, or no change once the next jump would leave the n shards."""
    hi, lo = s["hi"], s["lo"]
    by = F.lit(_LO).cast("long")
    # lo * _LO + 1, as 16-bit pieces of lo; what passes 2^32 is carried
    p0, p1 = _and(lo, _M16) * by, F.shiftrightunsigned(lo, 16) * by
    low = p0 + F.shiftleft(_and(p1, _M16), 16) + 1
    carry = F.shiftrightunsigned(low, 32) + F.shiftrightunsigned(p1, 16)
    cross = _and(hi, _M16) * by + F.shiftleft(_and(F.shiftrightunsigned(hi, 16) * by, _M16), 16)
    new_hi = _and(carry + _and(lo * F.lit(_HI).cast("long"), _M32) + _and(cross, _M32), _M32)
    new_lo = _and(low, _M32)
    jump = F.floor((s["j"] + 1).cast("double") * float(1 << 31)
                   / (F.shiftrightunsigned(new_hi, 1) + 1).cast("double")).cast("long")
    going = s["j"] < n
    return F.struct(F.when(going, new_hi).otherwise(hi).alias("hi"),
                    F.when(going, new_lo).otherwise(lo).alias("lo"),
                    F.when(going, s["j"]).otherwise(s["b"]).alias("b"),
                    F.when(going, jump).otherwise(s["j"]).alias("j"))


def jump_hash(key: Column, n_shards: int) -> Column:
    """Shard 0..n_shards-1 of a long key (its 64 bits, unsigned). A null key counts as 0.

    j grows by at least 1 with each step, so n_shards steps always suffice.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), _and(key, _M32).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    steps = F.sequence(F.lit(1), F.lit(n_shards))
    return F.aggregate(steps, start, lambda s, _: _step(s, n_shards), lambda s: s["b"].cast("int"))


def assign_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                  rows_per_range: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, one row per input row.

    size is the UTF-8 length plus 8. Slots number a shard's rows from 0 without gaps. A
    shard is numbered in hash ranges of its keys, ``rows_per_range`` rows each on average:
    the ranges' counts are summed first, and only one range's rows meet in a task. Texts are
    read once; what is needed of them is written to the shared folder. Null text: no bytes; null id: key 0. Repeated rows each get a slot of their own;
    rows with one id share a shard by definition. An empty table gives no rows.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(utf8(F.col("text"))) + 8).cast("long").alias("size"),
        F.crc32(utf8(F.col("text"))).alias("text_crc32"))
    rows = materialize(rows.select("*", jump_hash(F.col("doc_id"), n_shards).alias("shard"),
                                   jump_hash(F.col("doc_id"), n_shards + 1).alias("grown_shard")), "shard-rows")
    n_ranges = max(1, -(-rows.count() // (rows_per_range * n_shards)))
    rows = rows.withColumn("range", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_ranges)).cast("int"))
    counts = rows.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("rn", F.row_number().over(within).cast("long"))
            .join(offsets, ["shard", "range"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("rn") - 1).cast("long").alias("slot"), "grown_shard"))


__all__ = ["jump_hash", "assign_shards"]
