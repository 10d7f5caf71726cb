"""A set of hashes as a bitmap of fixed size, to drop rows early that a later join would drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** BITMAP_BITS bits are 512 KB: the size does not follow the data. A fuller bitmap lets more
#: rows through, which the join behind it drops.
BITMAP_BITS = 22


def _slot(token: Column) -> Column:
    return F.shiftrightunsigned(token, 64 - BITMAP_BITS)


def bitmap_of(tokens: DataFrame) -> Column:
    """A scalar subquery with the bits of all values of column `token`, as one array of longs."""
    longs = 1 << (BITMAP_BITS - 6)
    bits = tokens.select(_slot(F.col("token")).alias("s")).select(
        F.shiftright("s", 6).alias("i"),
        F.expr("shiftleft(1L, cast(s & 63 AS INT))").alias("bit"),
    )
    held = bits.groupBy("i").agg(F.bit_or("bit").alias("bits"))
    every = tokens.sparkSession.range(longs).withColumnRenamed("id", "i")
    full = every.join(held, "i", "left").select("i", F.coalesce("bits", F.lit(0)).alias("bits"))
    return full.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("i", "bits"))), lambda x: x["bits"]
        ).alias("bitmap")
    ).scalar()


def in_bitmap(bitmap: Column, token: Column) -> Column:
    slot = _slot(token)
    held = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    return held.bitwiseAND(bit) != 0
