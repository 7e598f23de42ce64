"""Pings stored in the order that trips are read in.

A run of segments shuffles its pings by vehicle, route, day and range. Where pings are
read more often than loaded, that shuffle can be paid once: ``store_trips`` places each
ping in its range (``operators.previous``), deals pings to buckets by vehicle, route and
range, and sorts a bucket by the trips' order. Readers get the same segments with no
exchange before the window, roll-ups by vehicle and route within a range start without
one too, and a vehicle's rows lie together, so files skip by their statistics. A trip
that holds much of a day is cut into ranges and so spread over buckets.

Days are the unit: storing pings replaces the days that they have, or those named, as
one version of the warehouse. All days of a table have one number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbook.operators.previous import with_ranges
from roadbook.plans.silver import TRIP_KEYS, TRIP_ORDER, lag_of_stored, segments_of_lagged
from roadbook.sources.warehouse import Version, Warehouse

TRIPS = "raw.trips"
DAY = "event_date"
BUCKETED = ["vehicle_id", "route_id", "_range"]
# files of a day: a day of 100 GB makes files of 200 MB
BUCKETS = 512


def _buckets(warehouse: Warehouse) -> int:
    """As the stored schema says."""
    schema = T.StructType.fromJson(warehouse.version().tables[TRIPS]["schema"])
    return schema["_range"].metadata["buckets"]


def store_trips(warehouse: Warehouse, pings: DataFrame, days: Iterable[date | None] | None = None,
                buckets: int = BUCKETS, **sizes: int) -> Version:
    """Store staged pings by their trips in place of the days that they have, or of ``days``, also by nothing.

    ``buckets`` counts for a new table; a stored one keeps its own.
    """
    base = warehouse.at()
    buckets = _buckets(base) if TRIPS in base.version().tables else buckets
    if days is not None:
        wanted = list(days)
        dated = [d for d in wanted if d is not None]
        in_days = F.col(DAY).isin(dated) if dated else F.lit(False)
        pings = pings.where(F.coalesce(in_days, F.lit(False)) | (F.col(DAY).isNull() if None in wanted else F.lit(False)))
    else:  # each is a folder, which the driver lists anyway
        wanted = [r[0] for r in pings.select(DAY).distinct().collect()]
    placed = with_ranges(pings, TRIP_KEYS, TRIP_ORDER, **sizes)
    placed = placed.select(*[c for c in placed.columns if c not in ("_range", DAY)],
                           F.col("_range").alias("_range", metadata={"buckets": buckets}), DAY)
    run = base.begin()
    try:
        run.write_bucketed(placed, TRIPS, DAY, BUCKETED, [*BUCKETED, *TRIP_ORDER], buckets)
        return warehouse.publish(run, {TRIPS: wanted}, base.version(), [TRIPS])
    finally:
        run.remove()


def stored_trips(warehouse: Warehouse) -> DataFrame:
    """The pings with ``_range`` and ``_split``, dealt as they are stored."""
    now = warehouse.at()
    return now.read_bucketed(TRIPS, BUCKETED, _buckets(now))


def stored_segments(warehouse: Warehouse, routes: DataFrame) -> DataFrame:
    """``int_route_segments`` of the stored pings."""
    return segments_of_lagged(lag_of_stored(stored_trips(warehouse)), routes)
