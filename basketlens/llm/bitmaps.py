"""A bitmap of fixed size over a set of keys, to send fewer rows into a join.

A key sets one of 2^26 bits; 32,768 bits are a row, so the table has at most
2048 rows of 4 KB and is broadcast whatever the keys' number. A key of the
set always finds its bit, others seldom while the set is small against the
bitmap; past that fewer rows are saved, so an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import stage

_BITS = 1 << 26


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(_BITS))


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """``part, bits`` of the column's values."""
    slots = keys.select(_slot(key).alias("slot"))
    return stage(slots.groupBy(F.shiftright("slot", 15).alias("part"))
                 .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("bits")), "bitmap")


def marked(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """``df`` with ``met``: false only where the key is not in the set."""
    placed = df.withColumn("slot", _slot(key)).withColumn("part", F.shiftright("slot", 15))
    byte = F.expr("cast(conv(hex(substring(bits, cast((slot & 32767) >> 3 as int) + 1, 1)), 16, 10) as bigint)")
    met = F.coalesce(F.getbit(byte, F.expr("cast(slot & 7 as int)")) == 1, F.lit(False))
    return placed.join(F.broadcast(bits), "part", "left").withColumn("met", met).select(*df.columns, "met")
