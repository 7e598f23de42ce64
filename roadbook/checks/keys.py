"""Uniqueness of a batch against what is already checked.

Checked keys are stored: for each unit (a batch, or a day) one row a key with how
often it occurs, in the table itself and in each view of it, sorted by a bucket of
the key's hash. Replacing some units changes the count of repeated values only for
keys that these units hold, before or after. So only those keys meet the rest of the
store, and of it only the buckets that they fall into are read: the store's row
groups are sorted by bucket and skipped by its statistics. Before the meeting a
filter takes away stored keys that cannot be touched ones: a bitmap of 4 KB for each
touched bucket, 16 MB at most, is sent to where the store is read. So the semi-join
moves the touched keys and few others, and no key of an unchanged unit is grouped again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
_BITS = 32_768  # of a bitmap, as Spark builds them


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def key_rows(df: DataFrame, column: str, unit: str, parts: list[Column]) -> DataFrame:
    """``unit, bucket, key, n0, n1, …``: how often each key occurs in a unit, among the rows of each part."""
    key = F.col(column).cast("string")
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(unit), key.alias("key")).agg(
        *[F.count_if(own).alias(f"n{i}") for i, own in enumerate(parts)])
    return counted.select(unit, bucket_of(F.col("key")).alias("bucket"), "key", *[f"n{i}" for i in range(len(parts))])


def touched_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """The keys of the units that are replaced, before and after."""
    return old.select("bucket", "key").union(new.select("bucket", "key")).distinct()


def _bit(key: Column) -> Column:
    """A key's place in its bucket's bitmap; the seed is another than the bucket's."""
    return F.pmod(F.xxhash64(key, F.lit("bit")), F.lit(_BITS))


def maybe_touched(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """The stored rows whose bit some touched key of their bucket has set: all that are touched, and few others."""
    seen = touched.groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(_bit(F.col("key")) + 1)).alias("_seen"))
    at = _bit(F.col("key"))
    byte = F.conv(F.hex(F.substr("_seen", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # at most BUCKETS bitmaps
    return rows.join(F.broadcast(seen), "bucket").where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def added_repeats(rest: DataFrame, old: DataFrame, new: DataFrame, touched: DataFrame, parts: int,
                  buckets: list[int] | None = None) -> DataFrame:
    """One row ``r0, r1, …``: by how much the number of values that occur more than once grows, for each part.

    ``old`` are the stored rows of the units that are replaced, ``new`` those that take their place and ``rest``
    all others. ``buckets`` names those that the touched keys fall into, so that no other is read.
    """
    names = [f"n{i}" for i in range(parts)]
    if buckets is not None:
        rest = rest.where(F.col("bucket").isin(buckets))
    met = maybe_touched(rest, touched).join(touched, ["bucket", "key"], "left_semi")

    def counted(rows: DataFrame, before: bool, after: bool) -> DataFrame:
        none = F.lit(0).cast("long")
        return rows.select("bucket", "key", *[(F.col(n) if before else none).alias(f"b_{n}") for n in names],
                           *[(F.col(n) if after else none).alias(f"a_{n}") for n in names])

    every = counted(met, True, True).union(counted(old, True, False)).union(counted(new, False, True))
    totals = every.groupBy("bucket", "key").agg(*[F.sum(f"{w}_{n}").alias(f"{w}_{n}") for n in names for w in "ba"])
    return totals.agg(*[(F.count_if(F.col(f"a_{n}") > 1) - F.count_if(F.col(f"b_{n}") > 1)).alias(f"r{i}") for i, n in enumerate(names)])


def buckets_of(touched: DataFrame) -> list[int]:
    """The touched buckets, ``BUCKETS`` at most."""
    return [r.bucket for r in touched.select("bucket").distinct().collect()]
