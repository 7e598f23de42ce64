"""Every named query against its SQL in another engine, exactly."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from conftest import TINY

from roadbook import catalog, oracle  # noqa: E402

QUERIES, SQL = catalog.QUERIES, oracle.statements()


@pytest.fixture(scope="module")
def con():
    return connect(TINY)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == SQL.keys() and len(QUERIES) >= 39
    assert QUERIES.keys() <= contract.queries().keys() and contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, TINY), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 494


def test_results_do_not_depend_on_the_session_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        for name in ("int_route_segments", "mart_fleet_health", "mart_driver_performance", "ingest_csv_clean"):
            assert difference(QUERIES[name](spark, TINY), con, SQL[name]) is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_quality_keys_have_failing_and_passing_rows_of_every_kind(con):
    rows = con.execute(SQL["dq_report"]).fetchall()
    for kind in ("not_null", "unique", "accepted_values", "range", "positive"):
        assert {bool(r[4]) for r in rows if r[1] == kind} == {True, False}, kind
    for layer in ("raw", "silver"):
        assert any(r[0].startswith(layer) and not r[4] for r in rows), layer


def test_every_reject_reason_is_met(con):
    reasons = {r[0] for r in con.execute(f"SELECT DISTINCT reason FROM ({SQL['ingest_csv_rejects']})").fetchall()}
    assert reasons == {"malformed line", "missing event_id", "too long route_id", "bad speed_mph",
                       "out of bounds speed_mph", "bad heading_deg"}


def test_building_a_query_starts_no_job(spark):
    context = spark.sparkContext
    for name, build in QUERIES.items():
        context.setJobGroup(f"build-{name}", name)
        build(spark, TINY)
        assert not context.statusTracker().getJobIdsForGroup(f"build-{name}"), name
