"""Stored trips give the segments of the pings they were stored from, without a shuffle before the window."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from roadbook.plans.silver import int_route_segments, lag_of_stored
from roadbook.sources import trips
from roadbook.sources.warehouse import Warehouse

from conftest import ping

DAYS = [date(2024, 1, 15), date(2024, 1, 16), None]


def pings(frame, n=40, speed=30.0, days=DAYS):
    """A hot trip of half the pings of a day, one without times, and others, also without a vehicle or a route."""
    rows = []
    for day in days:
        for i in range(n):
            vehicle, route = ("VH-1", "RT-1") if i % 2 else (f"VH-{i % 5}", [None, "RT-2", "RT-9"][i % 3])
            rows.append(ping(f"E{i:03d}", None if i % 7 == 0 else f"2024-01-15 08:{i:02d}:00", vehicle if i % 11 else None, route,
                             29.7 + i / 100, -95.4, speed, day))
    return frame("gps_events", rows)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def routes(frame):
    return frame("routes", [{"route_id": "RT-1", "route_name": "one", "zone": "Z"}, {"route_id": "RT-2", "route_name": "two"}])


def test_same_segments_without_an_exchange(spark, frame, routes, tmp_path):
    warehouse, gps = Warehouse(spark, str(tmp_path)), pings(frame)
    trips.store_trips(warehouse, gps, buckets=5, sample=1, per_range=3)
    stored = trips.stored_trips(warehouse)
    assert stored.where("_split").select("_range").distinct().count() > 2  # the hot trip lies in several buckets
    assert bag(trips.stored_segments(warehouse, routes)) == bag(int_route_segments(gps, routes))
    lagged = lag_of_stored(stored)
    lagged.collect()
    plan = lagged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 5 out of 5" in plan
    # the one shuffle left holds a row for each range of a hot trip
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("_key0" in line for line in shuffles)


def test_a_day_is_replaced_and_others_stay(spark, frame, routes, tmp_path):
    warehouse, old = Warehouse(spark, str(tmp_path)), pings(frame)
    trips.store_trips(warehouse, old, buckets=3)
    before = trips.stored_trips(warehouse)
    new = pings(frame, 12, 9.0, DAYS[1:])
    trips.store_trips(warehouse, new, buckets=8)  # the stored number counts
    kept = old.where(F.col("event_date") == F.lit(DAYS[0]))
    assert bag(trips.stored_segments(warehouse, routes)) == bag(int_route_segments(kept.unionByName(new), routes))
    assert before.count() == old.count()  # a reader ends on the version it began with
    trips.store_trips(warehouse, old, days=[DAYS[1]])
    trips.store_trips(warehouse, old.limit(0), days=[None])
    expected = old.where("event_date is not null")
    assert bag(trips.stored_segments(warehouse, routes)) == bag(int_route_segments(expected, routes))


def test_a_failed_write_leaves_nothing(spark, frame, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    broken = pings(frame).withColumn("lat", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        trips.store_trips(warehouse, broken, days=DAYS, buckets=3)
    assert trips.TRIPS not in warehouse.version().tables
    trips.store_trips(warehouse, pings(frame), buckets=3)
    assert trips.stored_trips(warehouse).count() == 120


def test_days_are_pruned(spark, frame, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    trips.store_trips(warehouse, pings(frame), buckets=3)
    one = trips.stored_trips(warehouse).where(F.col("event_date") == F.lit(DAYS[0]))
    assert one.count() == 40 and len(one.inputFiles()) <= 3 * 3
    assert "PartitionFilters: [isnotnull(event_date" in one._jdf.queryExecution().executedPlan().toString()
