from __future__ import annotations

from datetime import date, timedelta

import pytest

from roadbook.plans import metrics, serving

AS_OF = date(2024, 1, 30)


@pytest.fixture(scope="module")
def efficiency(spark):
    rows = [(f"R{r:02d}", f"Route {r}", "North" if r % 2 else "South", f"D{r % 3}", AS_OF - timedelta(days=d),
             r, None if r == 12 else 20.0 + r, 1.5, float((r * 7 + d) % 30), 3, 50.0 + r)
            for r in range(13) for d in (0, 7, 8, 29, 30, 31)]
    return spark.createDataFrame(
        rows, "route_id string, route_name string, zone string, district string, segment_date date, "
              "vehicles_on_route bigint, avg_speed double, total_miles double, avg_idle_pct double, "
              "total_events bigint, efficiency_score double")


@pytest.fixture(scope="module")
def health(spark):
    rows = [(f"V{i:02d}", "make", "model", 2020, ["light", "medium", "heavy"][i % 3],
             "active" if i < 9 else "inactive", None, days, cost, 1, urgency)
            for i, (days, cost, urgency) in enumerate(
                [(100 + i, 1.25, "high") for i in range(12)] + [(70, 2.5, "medium"), (None, None, "low")])]
    return spark.createDataFrame(
        rows, "vehicle_id string, make string, model string, year int, vehicle_class string, status string, "
              "last_service_date date, days_since_service int, total_cost_ytd double, "
              "total_service_events bigint, maintenance_urgency string")


def test_nulls_sort_as_the_largest(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9)], "k string, n int")
    assert [r.n for r in df.orderBy(*serving.descending("n", "k")).collect()] == [None, 9, 5]
    assert [r.n for r in df.orderBy(*serving.ascending("n", "k")).collect()] == [5, 9, None]


def test_last_week_has_no_upper_bound_and_includes_its_first_day(efficiency):
    rows = serving.top_idle_routes_last_week(efficiency, AS_OF).collect()
    expected = sorted(((-((r * 7 % 30) + ((r * 7 + 7) % 30)) / 2, f"R{r:02d}") for r in range(13)))[:10]
    assert [(-r.avg_idle_pct, r.route_id) for r in rows] == expected


def test_lowest_efficiency_is_month_to_date(efficiency):
    rows = serving.lowest_efficiency_routes(efficiency, AS_OF).collect()
    assert [r.route_id for r in rows] == [f"R{r:02d}" for r in range(10)]
    assert serving.lowest_efficiency_routes(efficiency, date(2024, 2, 1)).count() == 0


def test_top_k_keeps_its_limit_small(efficiency):
    plan = serving.lowest_efficiency_routes(efficiency, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_overdue(health):
    rows = serving.vehicles_overdue_maintenance(health).collect()
    assert [r.days_since_service for r in rows] == [*range(111, 99, -1), 70]


def test_speed_by_zone_puts_unknown_last_day_first(efficiency):
    rows = serving.avg_speed_by_zone(efficiency).collect()
    assert [(r.zone, r.avg_speed_mph) for r in rows] == [("North", 26.0), ("South", 25.0)]


def test_cost_by_class(health):
    rows = serving.monthly_fleet_cost(health).collect()
    assert [(r.vehicle_class, r.total_cost_usd) for r in rows] == [("light", 7.5), ("heavy", 5.0), ("medium", 5.0)]


def test_window_and_route_selection(efficiency):
    start, end = serving.default_window(AS_OF)
    assert (start, end) == (date(2023, 12, 31), AS_OF)
    assert serving.efficiency_rows(efficiency, start, end).count() == 13 * 5
    assert serving.efficiency_rows(efficiency, start, end, []).count() == 13 * 5
    chosen = serving.efficiency_rows(efficiency, start, end, ["R01", "R02"])
    assert chosen.count() == 10 and chosen.columns[0] == "segment_date"
    assert serving.default_routes(efficiency) == ["R00", "R01", "R02", "R03", "R04"]


def test_fleet_health_rows(health):
    assert serving.fleet_health_rows(health).first().days_since_service is None
    assert {r.vehicle_class for r in serving.fleet_health_rows(health, ["heavy"]).collect()} == {"heavy"}
    assert "status" not in serving.fleet_health_rows(health.drop("status")).columns


def test_kpis(efficiency, health):
    row = serving.kpis(efficiency, health).first()
    assert row.asDict() == {"active_routes": 13, "avg_speed": 25.5, "fleet_utilisation": 64.3,
                            "maintenance_alerts": 13}


def test_kpis_of_nothing(efficiency, health):
    row = serving.kpis(efficiency.limit(0), health.limit(0)).first()
    assert tuple(row) == (0, 0.0, 0.0, 0)


def test_daily_trend(efficiency):
    rows = serving.daily_trend(efficiency).collect()
    assert len(rows) == 6 and rows[0].segment_date < rows[-1].segment_date
    assert rows[0].avg_speed == 25.5


def test_urgency_counts_fill_missing_levels(health):
    high = health.where("maintenance_urgency = 'high'")
    assert [tuple(r) for r in serving.urgency_counts(high).collect()] == [("low", 0), ("medium", 0), ("high", 12)]


def test_top_urgent(health):
    rows = serving.top_urgent(health).collect()
    assert [r.days_since_service for r in rows] == list(range(111, 101, -1))


def test_metric_defaults(efficiency):
    marts = {"mart_route_efficiency": efficiency}
    row = metrics.metric_query(marts, "mart_route_efficiency", ["zone"],
                               ["avg_speed", "total_miles", "vehicles_on_route"],
                               where={"zone": ["North"]}).first()
    assert tuple(row) == ("North", 26.0, 6 * 6 * 1.5, 6 * (1 + 3 + 5 + 7 + 9 + 11))


def test_metric_range(efficiency):
    rows = metrics.metric_query({"mart_route_efficiency": efficiency}, "mart_route_efficiency",
                                ["segment_date"], ["vehicles_on_route"],
                                where={"segment_date": (AS_OF - timedelta(days=8), None)}).collect()
    assert sorted(r.segment_date for r in rows) == [AS_OF - timedelta(days=d) for d in (8, 7, 0)]


def test_metric_order_and_limit(efficiency):
    rows = metrics.metric_query({"mart_route_efficiency": efficiency}, "mart_route_efficiency", ["route_id"],
                                ["efficiency_score"], order=serving.descending("efficiency_score", "route_id"),
                                limit=2).collect()
    assert [r.route_id for r in rows] == ["R12", "R11"]


@pytest.mark.parametrize(("table", "dimensions", "measures", "where"), [
    ("nowhere", [], [], None),
    ("mart_fleet_health", ["zone"], ["total_cost_ytd"], None),
    ("mart_fleet_health", ["make"], ["avg_speed"], None),
    ("mart_fleet_health", ["make"], ["total_cost_ytd"], {"zone": ["x"]}),
    ("mart_fleet_health", ["make"], ["total_cost_ytd"], {"vehicle_class": ["huge"]}),
])
def test_unknown_metrics_are_refused(health, table, dimensions, measures, where):
    with pytest.raises(metrics.UnknownMetric):
        metrics.metric_query({"mart_fleet_health": health}, table, dimensions, measures, where)


def test_registry_size():
    assert {n: (len(t.dimensions), len(t.measures)) for n, t in metrics.METRIC_TABLES.items()} == {
        "mart_route_efficiency": (5, 5), "mart_fleet_health": (7, 2), "mart_driver_performance": (3, 4)}


def test_answers(efficiency, health):
    marts = {"mart_route_efficiency": efficiency, "mart_fleet_health": health}
    by_name = metrics.answer("avg_speed_by_zone", marts, AS_OF).collect()
    by_question = metrics.answer("What is the average speed by route zone?", marts, AS_OF).collect()
    assert by_name == by_question
    for name in metrics.VERIFIED:
        assert metrics.answer(name, marts, AS_OF).columns
    with pytest.raises(metrics.UnknownMetric, match="no verified query"):
        metrics.answer("How is the weather?", marts, AS_OF)
