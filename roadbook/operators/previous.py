"""The previous row of each group, also when one group holds most of the data.

A window over a whole group puts it into one task. Here a heavy group is cut into
ranges of its whole order, and the lag is taken inside each range; the first row of
a range gets the last row of the range before it, carried over from a small table
of range ends. Where the ranges begin is told by a sample: a fixed share of all
rows by hash, sorted within each group, of which every so many-th row begins a
range. A group with few rows has no such row and stays whole.

One lazy path for every size and one full shuffle. The sample and the range ends
are read beside it; both joins send a table of at most ``MOST_RANGES`` rows (and
half as many groups), whatever the size of the data: where the sample holds more,
ranges grow. A row finds its range by binary search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# One row in SAMPLE is sampled, and PER_RANGE sampled rows make a range: about 65,536 rows.
SAMPLE, PER_RANGE = 1024, 64
MOST_RANGES = 2**17
_STEPS = 18  # halvings that find a place among MOST_RANGES


def _place(order: list[str]) -> Column:
    """A row's place in the order as one value; NULLs sort last."""
    return F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(f"o{i}") for i, c in enumerate(order)])


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal keys, NULL being one; ``right`` holds them as ``_key<i>``."""
    condition = F.lit(True)
    for i, name in enumerate(names):
        condition = condition & left[name].eqNullSafe(right[f"_key{i}"])
    return condition


def range_starts(df: DataFrame, keys: list[str], order: list[str], sample: int = SAMPLE, per_range: int = PER_RANGE,
                 most: int = MOST_RANGES) -> DataFrame:
    """For each heavy group ``_key<i>`` and ``_starts``, the places at which its ranges begin, the first one's left out."""
    picked = df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(sample)) == 0).select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], _place(order).alias("_place")).distinct()
    names = [f"_key{i}" for i in range(len(keys))]
    # a group of fewer than two ranges is no heavy one, so the lists hold only what may begin a range
    groups = picked.groupBy(*names).agg(F.sort_array(F.collect_list("_place")).alias("_places")).where(
        F.size("_places") >= 2 * per_range)
    step = F.greatest(F.lit(per_range), F.ceil(F.sum(F.size("_places")) / F.lit(most)))
    steps = groups.agg(F.coalesce(step, F.lit(per_range)).cast("int").alias("_step"))
    starts = F.transform(F.sequence(F.col("_step") + 1, F.size("_places"), F.col("_step")), lambda at: F.element_at("_places", at))
    return groups.join(F.broadcast(steps)).where(F.size("_places") >= 2 * F.col("_step")).select(*names, starts.alias("_starts"))


def _range(place: Column, starts: Column) -> Column:
    """How many of the sorted starts are not after the place."""
    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        begun = F.get(starts, middle) <= place
        return F.when(low >= high, state).otherwise(F.struct(
            F.when(begun, middle + 1).otherwise(low).alias("low"), F.when(begun, high).otherwise(middle).alias("high")))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), F.struct(F.lit(0).alias("low"), F.size(starts).alias("high")), halve)
    return F.when(starts.isNull(), 0).otherwise(found["low"])


def with_ranges(df: DataFrame, keys: list[str], order: list[str], **sizes: int) -> DataFrame:
    """Add ``_range``, which follows the order within a group, and ``_split``, whether the group is a heavy one."""
    starts = range_starts(df, keys, order, **sizes)
    # at most MOST_RANGES places of order columns, by the step above
    joined = df.join(F.broadcast(starts), _same(df, starts, keys), "left")
    return joined.select(*[df[c] for c in df.columns], _range(_place(order), F.col("_starts")).alias("_range"),
                         F.col("_starts").isNotNull().alias("_split"))


def with_previous(df: DataFrame, keys: list[str], order: list[str], columns: list[str], **sizes: int) -> DataFrame:
    """Add ``prev_<column>``: the value one row earlier by ``order`` within ``keys``.

    NULLs sort last. Rows that are equal in ``order`` have no order of their own,
    so give it enough columns; such rows are also never parted.
    """
    return previous_of_placed(with_ranges(df, keys, order, **sizes), keys, order, columns).drop("_range", "_split")


def previous_of_placed(placed: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The same for rows whose ``_range`` and ``_split`` are known, as stored ones' are."""
    values = F.struct(*columns)

    # the last row of each range of a heavy group, handed to the next range: one row a range
    ends = (placed.where("_split").groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"))
            .agg(F.max_by(values, _place(order)).alias("_end")))
    across = Window.partitionBy(*[f"_key{i}" for i in range(len(keys))]).orderBy("_at")
    carried = ends.withColumn("_carried", F.lag("_end").over(across)).where("_carried is not null").drop("_end")

    inside = Window.partitionBy(*keys, "_range").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    lagged = placed.withColumn("_before", F.lag(values).over(inside))
    joined = lagged.join(F.broadcast(carried), _same(lagged, carried, keys) & (F.col("_range") == F.col("_at")), "left")
    before = F.coalesce("_before", "_carried")  # inside a range a lag is a row, also one of NULLs
    return joined.select(*[lagged[c] for c in placed.columns], *[before[c].alias(f"prev_{c}") for c in columns])
