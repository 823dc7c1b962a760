"""Bit strings of 32768 positions, as bitmap_construct_agg makes them, and sets of numbers kept in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 15


def bit_at(bits: Column, position: Column) -> Column:
    """Whether the bit is set; false for a null bit string."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), F.pmod(position, F.lit(8)).cast("int") + 1)
    return F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))


def bitmap_of(rows: DataFrame, slot: str) -> DataFrame:
    """The set of the numbers (bigint, from 0) in a column: as many strings of 4 KB as there are spans of SPAN numbers, whatever the rows."""
    return rows.groupBy(F.shiftright(slot, 15).alias("__bucket")).agg(F.bitmap_construct_agg(F.col(slot).bitwiseAND(F.lit(SPAN - 1).cast("bigint"))).alias("__bits"))


def marked(rows: DataFrame, bitmap: DataFrame, slot: str, flag: str) -> DataFrame:
    """Adds a flag that tells rows whose number is in the set. The bitmap is broadcast: the numbers' range must be bounded."""
    at = rows.withColumn("__bucket", F.shiftright(slot, 15)).join(F.broadcast(bitmap), "__bucket", "left")
    return at.withColumn(flag, bit_at(F.col("__bits"), F.col(slot).bitwiseAND(F.lit(SPAN - 1).cast("bigint")))).drop("__bucket", "__bits")
