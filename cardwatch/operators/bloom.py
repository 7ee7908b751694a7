"""Rows of a large table that may meet a small set of keys, told before any shuffle.

The small side's keys set bits of a bitmap of fixed size, kept as a table of 64-bit words
(one row per word that has any bit set, at most ``2 ** (BITS - 6)``), which is broadcast.
The large side looks its key's bit up in a map-side join and loses the rows whose bit isn't
set.  No key of the small side is lost; of the others the share that stays is about the
keys' number by the bits'.  Nothing is counted or collected first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of the bitmap's size: 2 MB of bits in at most 262,144 rows.
BITS = 24


def may_meet(rows: DataFrame, key: str, small: DataFrame, small_key: str) -> DataFrame:
    """The rows whose ``key`` may be among ``small``'s; all that are, and few others.  NULL meets nothing."""
    def word(c):
        return F.pmod(F.xxhash64(c), F.lit(1 << (BITS - 6)))

    def bit(c):
        return F.shiftrightunsigned(F.xxhash64(c), 58).cast("int")

    words = (small.where(F.col(small_key).isNotNull())
             .select(word(small_key).alias("_word"), F.expr("1L").alias("_one"), bit(small_key).alias("_bit"))
             .groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", F.col("_one"), F.col("_bit"))).alias("_mask")))
    there = F.call_function("shiftrightunsigned", F.col("_mask"), bit(key)).bitwiseAND(F.lit(1)) == 1
    return (rows.where(F.col(key).isNotNull()).withColumn("_at", word(key))
            .join(F.broadcast(words), (F.col("_at") == F.col("_word")) & there, "inner")
            .drop("_at", "_word", "_mask"))
