"""The whole run on landed files: incremental equals full, reruns change nothing."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import TINY
from roadbook import fixtures
from roadbook.checks import quality
from roadbook.checks.quality import QualityGateFailed
from roadbook.plans import pipeline
from roadbook.schemas import TABLES as TABLES_
from roadbook.sources.landing import landing_folder
from roadbook.sources.warehouse import Warehouse

AS_OF = date(2024, 1, 30)


def land_frame(df, root, table, day):
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(
        landing_folder(str(root), table, day))


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """Two batches. The second repeats the dimensions and brings late pings too."""
    root = tmp_path_factory.mktemp("landing")
    gps = fixtures.gps_events(spark, TINY)
    late = (F.col("event_date") >= "2024-01-16") | F.col("event_id").endswith("3")
    for day, part in (("2024-01-15", gps.where(~late)), ("2024-01-30", gps.where(late))):
        for table in ("routes", "vehicles", "stops", "maintenance_logs"):
            rows = fixtures.RAW[table](spark, TINY)
            again = table == "maintenance_logs" and day == "2024-01-30"
            land_frame(rows.where("false") if again else rows, root, table, day)
        land_frame(part, root, "gps_events", day)
    return str(root)


def contents(warehouse, name):
    df = warehouse.read(name)
    df = df.select(*sorted(df.columns))
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


TABLES = ["silver.int_route_segments", "silver.int_vehicle_daily_stats", "gold.mart_route_efficiency",
          "gold.mart_fleet_health", "gold.mart_driver_performance"]


def test_daily_runs_equal_a_full_rebuild(spark, landing, tmp_path):
    daily = Warehouse(spark, str(tmp_path / "daily"))
    first = pipeline.run(spark, landing, daily.root, "2024-01-15", AS_OF, latest_dimensions=True)
    assert all(load.status == "success" for load in first.loads)
    assert max(first.dates) == date(2024, 1, 15)
    second = pipeline.run(spark, landing, daily.root, "2024-01-30", AS_OF, latest_dimensions=True)
    assert len(second.checks) == 74 + 9

    full = Warehouse(spark, str(tmp_path / "full"))
    pipeline.load_all(spark, landing, full)
    pipeline.rebuild(full, AS_OF, latest_dimensions=True)
    for name in TABLES:
        assert contents(daily, name) == contents(full, name), name

    before = {name: contents(daily, name) for name in TABLES}
    again = pipeline.run(spark, landing, daily.root, "2024-01-30", AS_OF, latest_dimensions=True)
    assert len(again.checks) == 74 + 9
    assert {name: contents(daily, name) for name in TABLES} == before

    in_box = pipeline.staged(pipeline.raw_tables(full))["stg_gps_events"].count()
    total = full.read("silver.int_vehicle_daily_stats").agg(F.sum("event_count")).first()[0]
    assert total == in_box
    scores = full.read("gold.mart_route_efficiency").agg(F.min("efficiency_score"), F.max("efficiency_score"))
    low, high = scores.first()
    assert 0 <= low <= high <= 100


def test_repeated_dimensions_fail_the_gate(spark, landing, tmp_path):
    """Appended loads repeat keys; by default that is reported, not repaired."""
    root = str(tmp_path / "wh")
    pipeline.run(spark, landing, root, "2024-01-15", AS_OF)
    before = {name: contents(Warehouse(spark, root), name) for name in TABLES}
    with pytest.raises(QualityGateFailed, match="raw.routes.route_id unique: 25"):
        pipeline.run(spark, landing, root, "2024-01-30", AS_OF)
    # what is published stays as it was, and the days are not forgotten
    assert {name: contents(Warehouse(spark, root), name) for name in TABLES} == before
    assert len(pipeline.pending_days(Warehouse(spark, root))) > 0


def test_undated_pings_are_rebuilt_too(spark, landing, tmp_path):
    known = F.when(~F.col("event_id").endswith("3"), F.col("event_date"))
    undated = fixtures.gps_events(spark, TINY).withColumn("event_date", known)
    for table in ("routes", "vehicles", "stops", "maintenance_logs"):
        land_frame(fixtures.RAW[table](spark, TINY), tmp_path, table, "2024-02-01")
    land_frame(undated, tmp_path, "gps_events", "2024-02-01")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    pipeline.load_all(spark, str(tmp_path), warehouse)
    dates = pipeline.days_of_batch(warehouse, "2024-02-01")
    assert None in dates and len(dates) > 1
    pipeline.rebuild(warehouse, AS_OF, dates, check=False)
    pipeline.rebuild(warehouse, AS_OF, dates, check=False)  # now over published tables
    in_box = pipeline.staged(pipeline.raw_tables(warehouse))["stg_gps_events"].count()
    assert warehouse.read("silver.int_route_segments").count() == in_box > 0
    assert warehouse.read("gold.mart_driver_performance").where("month IS NULL").count() > 0


def test_nothing_runs_without_the_files(spark, landing, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, landing, str(tmp_path / "wh"), "2024-02-01", AS_OF)


HEADS = {t: ",".join(TABLES_[t].names) for t in ("routes", "vehicles", "stops", "gps_events", "maintenance_logs")}
REST = {"routes": "R,n,z,d,3,2024-01-01T00:00:00", "vehicles": "V,m,x,2020,light,active,vin,tx",
        "stops": "S,R,n,1,29.7,-95.4,depot", "maintenance_logs": "L,V,oil,2024-01-02,{cost},5000,T,x"}


def land_lines(root, batch, pings, cost="10.5"):
    for table in HEADS:
        path = root / "raw" / table / f"date={batch}" / "f.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = pings if table == "gps_events" else [REST[table].format(cost=cost)]
        path.write_text("\n".join([HEADS[table], *lines]) + "\n")


def line(i, day, lat=29.7, speed=30):
    return f"E{i},V,R,{lat},-95.4,{speed},3,{day}T08:0{i}:00,{day}"


def published(spark, root):
    warehouse = Warehouse(spark, str(root))
    return {name: contents(warehouse, name) for name in TABLES}


CORRECTIONS = {
    "a batch that shrinks": [line(1, "2024-01-15")],
    "a ping that leaves the box": [line(0, "2024-01-14", lat=11.0), line(1, "2024-01-15")],
    "a month that becomes empty": [line(1, "2024-02-01")],
    "a ping that moves to another day": [line(0, "2024-01-16"), line(1, "2024-01-15")],
}


@pytest.mark.parametrize("what, full_refresh", [*[(w, False) for w in CORRECTIONS], ("a ping that leaves the box", True)])
def test_a_corrected_batch_equals_a_fresh_warehouse(spark, tmp_path, what, full_refresh):
    land_lines(tmp_path, "2024-01-15", [line(0, "2024-01-14"), line(1, "2024-01-15")])
    pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-15", AS_OF)
    land_lines(tmp_path, "2024-01-15", CORRECTIONS[what])
    pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-15", AS_OF, ["gps_events"], full_refresh=full_refresh)
    fresh = Warehouse(spark, str(tmp_path / "fresh"))
    pipeline.load_all(spark, str(tmp_path), fresh)
    pipeline.rebuild(fresh, AS_OF)
    assert published(spark, tmp_path / "wh") == published(spark, tmp_path / "fresh")


def test_a_failed_run_in_between_forgets_no_day(spark, tmp_path):
    for pings in ([line(0, "2024-01-14"), line(1, "2024-01-15")], [line(1, "2024-01-15"), line(1, "2024-01-15")], [line(2, "2024-01-16")]):
        land_lines(tmp_path, "2024-01-15", pings)
        if len({*pings}) < len(pings):
            with pytest.raises(QualityGateFailed, match="event_id unique"):
                pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-15", AS_OF)
        else:
            pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-15", AS_OF)
    pipeline.run(spark, str(tmp_path), str(tmp_path / "fresh"), "2024-01-15", AS_OF)
    assert published(spark, tmp_path / "wh") == published(spark, tmp_path / "fresh")


@pytest.mark.parametrize("number", ["1e15", "1e300"])
def test_no_number_stops_a_run(spark, tmp_path, number):
    pings = [line(0, "2024-01-14"), line(1, "2024-01-15", speed=number), line(2, "2024-01-15", lat=number)]
    land_lines(tmp_path, "2024-01-15", pings, cost=number)
    result = pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-15", AS_OF)
    assert {r.table: r.rows_errored for r in result.loads} == {"routes": 0, "vehicles": 0, "stops": 0, "gps_events": 2, "maintenance_logs": 1}
    assert Warehouse(spark, str(tmp_path / "wh")).read("silver.int_route_segments").count() == 1


def test_new_files_are_taken_once_and_equal_a_full_rebuild(spark, tmp_path):
    """Two runs, a late file between them, then a run without any."""
    def run():
        return pipeline.run_new_files(spark, str(tmp_path), str(tmp_path / "wh"), AS_OF)

    land_lines(tmp_path, "2024-01-15", [line(0, "2024-01-14"), line(2, "2024-01-15")])
    assert {(r.table, r.rows_loaded) for r in run().loads} == {("gps_events", 2), *((t, 1) for t in REST)}
    late = tmp_path / "raw" / "gps_events" / "date=2024-01-15" / "late.csv"
    late.write_text("\n".join([HEADS["gps_events"], line(1, "2024-01-15"), line(3, "2024-02-01")]) + "\n")
    second = run()
    assert [(r.table, r.rows_loaded) for r in second.loads] == [("gps_events", 4)]
    assert {str(d) for d in second.dates} == {"2024-01-14", "2024-01-15", "2024-02-01"}
    third = run()
    assert third.loads == [] and third.dates == []
    pipeline.run(spark, str(tmp_path), str(tmp_path / "fresh"), "2024-01-15", AS_OF)
    assert published(spark, tmp_path / "wh") == published(spark, tmp_path / "fresh")


def test_the_daily_gate_counts_no_rows_by_a_scan(spark, tmp_path, monkeypatch):
    """What a run's checks say was counted while its rows were written, and equals a report over whole tables."""
    land_lines(tmp_path, "2024-01-15", [line(0, "2024-01-14"), line(1, "2024-01-15")])
    with monkeypatch.context() as patch:
        patch.setattr(quality, "row_checks", lambda *_: 1 / 0)
        checks = pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-15", AS_OF).checks
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    raw = {f"raw.{t}": df for t, df in pipeline.raw_tables(warehouse).items()}
    whole = quality.report(raw, views=pipeline.staging.views()).unionByName(quality.report({n: warehouse.read(n) for n in TABLES}))
    assert sorted(map(tuple, checks)) == sorted(map(tuple, whole.collect())) and len(checks) == 74 + 9

    # a batch that fails publishes its rows as they landed, and nothing else; put right, it passes
    land_lines(tmp_path, "2024-01-16", [line(1, "2024-01-15"), line(2, "2024-01-16")])
    for table in ("routes", "vehicles", "maintenance_logs"):
        (tmp_path / "raw" / table / "date=2024-01-16" / "f.csv").write_text(HEADS[table] + "\n")
    before = published(spark, tmp_path / "wh")
    with pytest.raises(QualityGateFailed, match="raw.gps_events.event_id unique: 1; silver.stg_gps_events.event_id unique: 1"):
        pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"), "2024-01-16", AS_OF)
    assert published(spark, tmp_path / "wh") == before


def test_what_was_published_unchecked_is_checked_later(spark, tmp_path):
    """A table that went out without a gate is read whole by the next one."""
    land_lines(tmp_path, "2024-01-15", [line(0, "2024-01-14", speed=150), line(1, "2024-01-15")])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    pipeline.load_all(spark, str(tmp_path), warehouse)
    pipeline.rebuild(warehouse, AS_OF, check=False)
    run = warehouse.begin()
    spoilt = warehouse.read("silver.int_route_segments").withColumn("speed_mph", F.lit(None).cast("double"))
    run.write(spoilt, "silver.int_route_segments", "event_date")
    warehouse.publish(run, {"silver.int_route_segments": None})
    with pytest.raises(QualityGateFailed, match="silver.int_route_segments.speed_mph not_null: 1"):
        pipeline.rebuild(warehouse, AS_OF, [date(2024, 1, 15)])
    assert all(c.passed for c in pipeline.rebuild(warehouse, AS_OF))
