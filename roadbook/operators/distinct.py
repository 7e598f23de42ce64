"""Exact distinct counts that merge: states of days give the count of a month or a zone.

A count of distinct values cannot be summed, so each longer period would be counted
from its rows again. Here a day keeps which values it saw, as bitmaps: values are
numbered once, and a state row holds the bits of 32,768 numbers. States are merged by
or, whatever the days, and a count is the number of bits. Numbers are dealt within
hash buckets, so numbering needs no total order, and they are dense, so that bitmaps
are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMBERED_IN = 256  # buckets that values are numbered in side by side


def numbers(values: DataFrame, column: str, buckets: int = NUMBERED_IN) -> DataFrame:
    """``column, number`` for every different value but NULL."""
    bucket = F.pmod(F.xxhash64(column), F.lit(buckets))
    different = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_bucket", bucket)
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy(column)).cast("long") - 1
    return different.select(column, (nth * buckets + F.col("_bucket")).alias("number"))


def states(rows: DataFrame, numbered: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """``keys, block, bits``: which numbers the rows of each key hold."""
    met = rows.select(*keys, column).join(numbered, column)
    return met.groupBy(*keys, F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(states_: DataFrame, keys: list) -> DataFrame:
    """The states of coarser keys."""
    return states_.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(states_: DataFrame, keys: list[str], name: str) -> DataFrame:
    """How many different values each key has; keys without any are not there."""
    return states_.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
