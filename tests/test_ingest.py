"""Landing, parsing, rejects and load results on small files."""

from __future__ import annotations

import logging

import pytest

from roadbook.operators import rejects
from roadbook.schemas import TABLES
from roadbook.sources import landing, loader
from roadbook.sources.warehouse import Warehouse
from roadbook.streaming.incremental import load_new_files

DAY = "2024-01-15"

ROUTES = """route_id,route_name,zone,district,total_stops,created_at
RT-0001,"Main ""A"", loop",North,District-1,7,2024-01-01T06:00:00.123456
RT-0002,NULL,null,,,
"""

BAD_ROUTES = """route_id,route_name,zone,district,total_stops,created_at
RT-0001,ok,North,District-1,7,2024-01-01T06:00:00
RT-0002,short,North
RT-0003,long,North,District-1,7,2024-01-01T06:00:00,more
RT-0004,bad int,North,District-1,12.5,2024-01-01T06:00:00
,no key,North,District-1,7,2024-01-01T06:00:00
RT-000000000000000006,too long a key,North,District-1,7,2024-01-01T06:00:00
NULL,two faults,North,District-1,x,never
"""


def land(root, table, text, day=DAY, name=None):
    path = root / landing.landing_key(table, day, name or f"{table}.csv")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


@pytest.mark.parametrize("table", list(TABLES))
def test_landing_key(table):
    folder, name = landing.landing_key(table, "1999-12-31", "one of many.csv").rsplit("/", 1)
    assert (folder, name) == (landing.landing_folder("", table, "1999-12-31").lstrip("/"), "one of many.csv")


def test_missing_tables_are_named(spark, tmp_path):
    for table in TABLES:
        if table not in ("stops", "vehicles"):
            land(tmp_path, table, "header\n")
    land(tmp_path, "stops", "header\n", day="2024-01-14")
    assert landing.missing_tables(spark, str(tmp_path), DAY) == ["vehicles", "stops"]
    with pytest.raises(FileNotFoundError, match="vehicles.*stops"):
        landing.require_landed(spark, str(tmp_path), DAY)
    land(tmp_path, "vehicles", "header\n")
    land(tmp_path, "stops", "header\n")
    landing.require_landed(spark, str(tmp_path), DAY)


def test_csv_dialect(spark, tmp_path):
    land(tmp_path, "routes", ROUTES)
    parsed = rejects.parse(landing.read_landed(spark, str(tmp_path), "routes", DAY), "routes")
    first, second = rejects.accepted(parsed).orderBy("route_id").collect()
    assert first.route_name == 'Main "A", loop' and first.total_stops == 7
    assert first.created_at.microsecond == 123456
    assert str(first.date) == DAY
    assert [second[c] for c in ("route_name", "zone", "district", "total_stops", "created_at")] == [None] * 5
    assert dict(parsed.dtypes)["created_at"] == "timestamp_ntz"


def test_columns_go_by_position(spark, tmp_path):
    land(tmp_path, "routes", ROUTES.replace("route_id,route_name", "some,thing"))
    rows = rejects.accepted(rejects.parse(landing.read_landed(spark, str(tmp_path), "routes", DAY), "routes"))
    assert rows.where("route_id = 'RT-0001'").count() == 1


def test_each_bad_row_is_counted_once(spark, tmp_path):
    land(tmp_path, "routes", BAD_ROUTES)
    parsed = rejects.parse(landing.read_landed(spark, str(tmp_path), "routes", DAY), "routes")
    assert [r.route_id for r in rejects.accepted(parsed).collect()] == ["RT-0001"]
    reasons = sorted(r._reason for r in rejects.rejected(parsed, "routes").collect())
    assert reasons == ["bad total_stops", "malformed line", "malformed line", "missing route_id",
                       "missing route_id", "too long route_id"]
    summary = rejects.load_summary(parsed, "routes").first()
    assert tuple(summary) == ("routes", 1, 6, "partial")


def test_doubles_must_be_finite(spark):
    names = TABLES["stops"].names
    rows = [tuple({"stop_id": f"s{i}", "lat": v}.get(n) for n in names)
            for i, v in enumerate(["1.5", "NaN", "Infinity", "-Infinity", "x", "null", "1e400", "1e15", "-1e300"])]
    raw = spark.createDataFrame(rows, TABLES["stops"].string_schema())
    good = rejects.accepted(rejects.parse(raw, "stops")).orderBy("stop_id").collect()
    assert [(r.stop_id, r.lat) for r in good] == [("s0", 1.5), ("s5", None)]


def test_notes_may_hold_newlines(spark, tmp_path):
    land(tmp_path, "maintenance_logs",
         "log_id,vehicle_id,service_type,service_date,cost_usd,mileage_at_service,technician,notes\n"
         'ML-1,VH-1,oil,2024-01-02,10.5,5000,T,"first\nsecond"\nML-2,VH-1,oil,2024-01-03,1,2,T,x\n')
    rows = rejects.accepted(rejects.parse(
        landing.read_landed(spark, str(tmp_path), "maintenance_logs", DAY), "maintenance_logs"))
    assert [r.notes for r in rows.orderBy("log_id").collect()] == ["first\nsecond", "x"]


def test_load_and_reload(spark, tmp_path, caplog):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path, "routes", ROUTES)
    land(tmp_path, "routes", BAD_ROUTES, day="2024-01-16")
    assert loader.load_table(spark, str(tmp_path), warehouse, "routes", DAY).status == "success"
    second = loader.load_table(spark, str(tmp_path), warehouse, "routes", "2024-01-16")
    assert (second.rows_loaded, second.rows_errored, second.status) == (1, 6, "partial")
    assert loader.raw_table(warehouse, "routes").count() == 3
    assert loader.rejected_rows(warehouse, "routes").count() == 6
    # again, one date and then the whole prefix: the table stays the same
    loader.load_table(spark, str(tmp_path), warehouse, "routes", "2024-01-16")
    assert loader.raw_table(warehouse, "routes").count() == 3
    whole = loader.load_table(spark, str(tmp_path), warehouse, "routes")
    assert (whole.rows_loaded, whole.rows_errored) == (3, 6)
    assert loader.raw_table(warehouse, "routes").count() == 3
    raw = loader.raw_table(warehouse, "routes")
    assert {"_loaded_at", "batch_date"} <= set(raw.columns) and raw.where("_loaded_at is null").count() == 0


def test_dates_no_longer_landed_are_kept(spark, tmp_path):
    warehouse, gone = Warehouse(spark, str(tmp_path / "wh")), land(tmp_path, "routes", ROUTES)
    loader.load_table(spark, str(tmp_path), warehouse, "routes")
    gone.rename(tmp_path / "archived.csv")
    gone.parent.rmdir()
    land(tmp_path, "routes", ROUTES.replace("RT-", "RX-"), day="2024-01-16")
    loader.load_table(spark, str(tmp_path), warehouse, "routes")
    assert sorted(r.route_id for r in loader.raw_table(warehouse, "routes").collect()) == ["RT-0001", "RT-0002", "RX-0001", "RX-0002"]


def test_a_batch_is_replaced_whole(spark, tmp_path):
    """Pings that moved to another day, then a batch that landed empty."""
    warehouse, head = Warehouse(spark, str(tmp_path / "wh")), "event_id,vehicle_id,route_id,lat,lon,speed_mph,heading_deg,event_ts,event_date\n"
    line = "E{0},V,R,29.7,-95.4,10.5,3,2024-01-1{1}T08:00:00,2024-01-1{1}\n"
    for days in ("44", "45", "5", ""):
        land(tmp_path, "gps_events", head + "".join(line.format(i, d) for i, d in enumerate(days)))
        loader.load_table(spark, str(tmp_path), warehouse, "gps_events", *([DAY] if len(days) % 2 else []))
        found = loader.raw_table(warehouse, "gps_events").orderBy("event_id").collect()
        assert [str(r.event_date)[-1] for r in found] == list(days)


def test_nothing_is_loaded_if_a_table_has_not_landed(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path, "routes", ROUTES)
    for day in (DAY, None):
        with pytest.raises(FileNotFoundError, match="stops"):
            loader.load_all(spark, str(tmp_path), warehouse, ["routes", "stops"], day)
    assert not warehouse.exists("raw.routes")


def test_command_line_reports_loads(spark, tmp_path, capsys, monkeypatch):
    from roadbook import __main__ as cli

    land(tmp_path, "routes", BAD_ROUTES)
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    assert cli.main(["load", "--landing", str(tmp_path), "--warehouse", str(tmp_path / "wh"), "--only", "routes", "--batch", DAY]) == 0
    assert capsys.readouterr().out.split("\n")[1].split() == [DAY, "routes", "7", "1", "6"]


def test_rejected_text_is_kept(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path, "routes", BAD_ROUTES)
    loader.load_table(spark, str(tmp_path), warehouse, "routes", DAY)
    kept = [r._raw for r in loader.rejected_rows(warehouse, "routes").collect()]
    assert any("12.5" in text for text in kept) and any("RT-0003,long" in text for text in kept)


def test_unknown_tables_are_skipped(spark, tmp_path, caplog):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path, "routes", ROUTES)
    with caplog.at_level(logging.WARNING):
        results = loader.load_all(spark, str(tmp_path), warehouse, ["nonsense", "routes"], DAY)
    assert [r.table for r in results] == ["routes"] and "nonsense" in caplog.text


def test_gps_is_stored_by_day(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path, "gps_events",
         "event_id,vehicle_id,route_id,lat,lon,speed_mph,heading_deg,event_ts,event_date\n"
         "E1,V,R,29.7,-95.4,10.5,3,2024-01-14T23:59:59,2024-01-14\n"
         "E2,V,R,29.7,-95.4,10.5,3,2024-01-15 00:00:01,2024-01-15\n")
    loader.load_table(spark, str(tmp_path), warehouse, "gps_events", DAY)
    day = loader.raw_table(warehouse, "gps_events").where("event_date = DATE '2024-01-15'")
    assert "event_date" in day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert [r.event_id for r in day.collect()] == ["E2"]


def test_empty_files_load_nothing(spark, tmp_path):
    warehouse, streamed = (Warehouse(spark, str(tmp_path / n)) for n in ("wh", "streamed"))
    land(tmp_path, "routes", ROUTES.splitlines()[0] + "\n")
    result = loader.load_table(spark, str(tmp_path), warehouse, "routes", DAY)
    assert (result.rows_loaded, result.rows_errored, result.status) == (0, 0, "success")
    assert loader.raw_table(warehouse, "routes").count() == 0
    result = load_new_files(spark, str(tmp_path), streamed, "routes", str(tmp_path / "checkpoint"))
    assert (result.rows_loaded, result.rows_errored) == (0, 0)


def test_streaming_takes_each_file_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    checkpoint = str(tmp_path / "checkpoint")

    def load():
        result = load_new_files(spark, str(tmp_path), warehouse, "routes", checkpoint)
        return result.rows_loaded, result.rows_errored

    land(tmp_path, "routes", ROUTES)
    assert load() == (2, 0)
    assert load() == (0, 0)
    land(tmp_path, "routes", BAD_ROUTES, day="2024-01-16")
    assert load() == (1, 6)
    land(tmp_path, "routes", ROUTES, name="late.csv")
    assert load() == (2, 0)
    stored = loader.raw_table(warehouse, "routes")
    assert stored.count() == 5
    assert sorted(str(r[0]) for r in stored.select("batch_date").distinct().collect()) == [DAY, "2024-01-16"]
    assert loader.rejected_rows(warehouse, "routes").count() == 6
