"""Silver and gold on literal frames."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from conftest import ping
from roadbook.operators import staging
from roadbook.plans import gold, silver

ROUTE = {"route_id": "RT-1", "route_name": "One", "zone": "North", "district": "District-1", "total_stops": 4}


@pytest.fixture
def models(frame):
    def build(pings, routes=(ROUTE,)):
        gps = staging.stg_gps_events(frame("gps_events", list(pings)))
        return silver.int_route_segments(gps, frame("routes", list(routes)))
    return build


def test_first_ping_and_elapsed(models):
    rows = models([
        ping("a", "2024-01-15T08:00:00.9", lat=29.7),
        ping("b", "2024-01-15T08:00:02.1", lat=29.71, speed=4.0),
    ]).orderBy("event_id").collect()
    assert rows[0].segment_distance_miles == 0.0 and rows[0].elapsed_mins is None
    assert rows[1].elapsed_mins == 2 / 60.0 and rows[1].idle_flag == 1
    assert rows[1].segment_distance_miles == pytest.approx(0.690938, abs=1e-4)


def test_trips_do_not_mix(models):
    rows = models([
        ping("a", "2024-01-15T08:00:00"),
        ping("b", "2024-01-15T08:01:00", vehicle="VH-2"),
        ping("c", "2024-01-15T08:02:00", route="RT-2"),
        ping("d", "2024-01-16T08:03:00", day=date(2024, 1, 16)),
    ]).collect()
    assert all(r.elapsed_mins is None for r in rows)


def test_equal_timestamps_go_by_id(models):
    rows = models([
        ping("b", "2024-01-15T08:00:00", lat=29.8),
        ping("a", "2024-01-15T08:00:00", lat=29.7),
    ]).orderBy("event_id").collect()
    assert [r.elapsed_mins for r in rows] == [None, 0.0]
    assert rows[1].segment_distance_miles > 0


def test_unknown_route_keeps_the_ping(models):
    row = models([ping("a", "2024-01-15T08:00:00", route="RT-9")]).first()
    assert (row.route_id, row.route_name, row.zone) == ("RT-9", None, None)


def test_pings_outside_the_box_are_not_segments(models):
    rows = models([
        ping("a", "2024-01-15T08:00:00", lat=29.4),
        ping("b", "2024-01-15T08:01:00"),
        ping("c", "2024-01-15T08:02:00", lat=None),
    ]).collect()
    assert [(r.event_id, r.elapsed_mins) for r in rows] == [("b", None)]


def test_duplicate_route_rows_fan_out(models):
    rows = models([ping("a", "2024-01-15T08:00:00")], routes=[ROUTE, ROUTE])
    assert rows.count() == 2


def test_daily_single_ping(models):
    row = silver.int_vehicle_daily_stats(models([ping("a", "2024-01-15T08:00:00")])).first()
    assert row.asDict() == {
        "vehicle_id": "VH-1", "event_date": date(2024, 1, 15), "trips_count": 1, "total_miles": 0.0,
        "avg_speed_mph": 30.0, "total_idle_mins": 0.0, "total_active_mins": None, "idle_pct": 0.0,
        "event_count": 1}


def test_daily_single_idle_ping_has_unknown_minutes(models):
    row = silver.int_vehicle_daily_stats(models([ping("a", "2024-01-15T08:00:00", speed=1.0)])).first()
    assert (row.total_idle_mins, row.total_active_mins, row.idle_pct) == (None, None, 0.0)


def test_daily_idle_share_is_of_minutes(models):
    row = silver.int_vehicle_daily_stats(models([
        ping("a", "2024-01-15T08:00:00"),
        ping("b", "2024-01-15T08:00:50", speed=2.0),
        ping("c", "2024-01-15T08:02:30", speed=40.0),
        ping("d", "2024-01-15T09:00:00", speed=40.0, route="RT-2"),
    ])).first()
    assert (row.trips_count, row.event_count) == (2, 4)
    assert (row.total_idle_mins, row.total_active_mins, row.idle_pct) == (0.83, 2.5, 33.33)
    assert row.avg_speed_mph == 28.0


def test_route_efficiency(models):
    pings = [ping(f"e{i}", f"2024-01-15T08:0{i}:00", speed=s)
             for i, s in enumerate([2.0, 37.0, 37.0, 37.0, 37.0])]
    row = gold.mart_route_efficiency(models(pings)).first()
    assert (row.avg_speed, row.avg_idle_pct, row.efficiency_score) == (30.0, 20.0, 88.5)
    assert (row.vehicles_on_route, row.total_events, row.total_miles) == (1, 5, 0.0)


def test_route_efficiency_of_unknown_speed(models):
    row = gold.mart_route_efficiency(models([ping("a", "2024-01-15T08:00:00", speed=None)])).first()
    assert (row.avg_speed, row.avg_idle_pct, row.efficiency_score) == (None, 0.0, None)


def test_unknown_routes_form_a_group(models):
    mart = gold.mart_route_efficiency(models([
        ping("a", "2024-01-15T08:00:00", route=None), ping("b", "2024-01-15T08:00:00", route=None, vehicle="VH-2")]))
    row = mart.first()
    assert mart.count() == 1 and (row.route_id, row.vehicles_on_route) == (None, 2)


def test_hot_trip_spans_hours(models):
    """One trip over several hours: each ping follows the one before it, also across the hour."""
    pings = [ping(f"h{i:04d}", f"2024-01-15T{8 + i // 60:02d}:{i % 60:02d}:00", lat=29.5 + i % 600 / 1000,
                  speed=float(i % 70)) for i in range(300)]
    rows = {r.event_id: r for r in models(pings).collect()}
    assert [r.elapsed_mins for _, r in sorted(rows.items())][1:] == [1.0] * 299
    row = silver.int_vehicle_daily_stats(models(pings)).first()
    assert (row.event_count, row.total_active_mins) == (300, 299.0)


def vehicle(vehicle_id, **more):
    return {"vehicle_id": vehicle_id, "make": "m", "model": "x", "year": 2020,
            "vehicle_class": "light", "status": "active", **more}


def service(log_id, vehicle_id, day, cost=100.0):
    return {"log_id": log_id, "vehicle_id": vehicle_id, "service_type": "oil",
            "service_date": day, "cost_usd": cost}


def test_fleet_health(frame):
    rows = gold.mart_fleet_health(
        frame("vehicles", [vehicle("a"), vehicle("b"), vehicle("c")]),
        frame("maintenance_logs", [
            service("1", "a", date(2023, 12, 31), 50.0), service("2", "a", date(2024, 2, 1), 10.005),
            service("3", "a", date(2024, 11, 1), 1.0),  # later in the year still counts
            service("4", "b", date(2023, 3, 1)), service("5", "b", None, 7.0),
        ]), date(2024, 4, 15)).orderBy("vehicle_id").collect()
    facts = [(r.last_service_date, r.days_since_service, r.total_cost_ytd,
              r.total_service_events, r.maintenance_urgency) for r in rows]
    assert facts == [
        (date(2024, 11, 1), -200, 11.01, 3, "low"),
        (date(2023, 3, 1), 411, 0.0, 2, "high"),
        (None, None, None, None, "low"),
    ]


def test_driver_performance_averages_days(spark, frame):
    daily = spark.createDataFrame([
        ("a", date(2024, 1, 1), 2, 10.0, 20.0, 1.0, 10.0, 10.0, 5),
        ("a", date(2024, 1, 2), 1, 5.0505, 45.01, 0.0, None, 0.0, 1),
        ("a", date(2024, 2, 1), 1, 1.0, 50.0, 0.0, 3.0, 0.0, 1),
        ("ghost", date(2024, 1, 1), 1, 1.0, None, None, None, 0.0, 1),
    ], "vehicle_id string, event_date date, trips_count bigint, total_miles double, avg_speed_mph double, "
       "total_idle_mins double, total_active_mins double, idle_pct double, event_count bigint")
    rows = gold.mart_driver_performance(daily, frame("vehicles", [vehicle("a")])) \
        .orderBy("vehicle_id", "month").collect()
    jan, feb, ghost = rows
    # 32.505 rounds up; minutes average over the one day that has them
    assert (jan.avg_speed, jan.idle_pct, jan.total_miles, jan.total_trips, jan.active_days,
            jan.avg_active_mins_per_day) == (32.51, 5.0, 15.05, 3, 2, 10.0)
    assert jan.safety_score == 82.95
    assert (feb.month, feb.safety_score) == (date(2024, 2, 1), 90.0)
    assert (ghost.make, ghost.avg_speed, ghost.safety_score) == (None, None, None)


def test_staging_keeps_load_time(spark, frame):
    from pyspark.sql import functions as F
    raw = frame("routes", [ROUTE]).withColumn("_loaded_at", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    assert staging.stg_routes(raw).columns[-1] == "_loaded_at"
