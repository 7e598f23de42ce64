from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadbook.checks import quality
from roadbook.checks.registry import CHECKS, REQUIRED_COLUMNS, Checks
from roadbook.schemas import TABLES


def outcome(df):
    return {(r.table_name, r.check_name, r.column_name): (r.failing_rows, r.passed) for r in df.collect()}


@pytest.fixture
def sample(spark):
    rows = [("a", "light", 1), ("a", "light", 2), ("b", "huge", -1), ("b", None, 0),
            ("b", "heavy", 500), (None, "light", None), (None, "medium", 5)]
    return spark.createDataFrame(rows, "id string, class string, n int")


CHECK = {"t": Checks(not_null=["id", "class"], unique=["id"], accepted={"class": ["light", "medium", "heavy"]},
                     ranges={"n": (0, 120)}, positive=["n"])}


def test_every_kind(sample):
    assert outcome(quality.report({"t": sample}, registry=CHECK)) == {
        ("t", "not_null", "id"): (2, False),
        ("t", "not_null", "class"): (1, False),
        ("t", "unique", "id"): (2, False),            # two values repeat; NULLs do not count
        ("t", "accepted_values", "class"): (1, False),  # NULL passes
        ("t", "range", "n"): (2, False),
        ("t", "positive", "n"): (2, False),
    }


def test_empty_table_passes(sample):
    assert all(passed for _, passed in outcome(quality.report({"t": sample.limit(0)}, registry=CHECK)).values())


def test_registry_is_complete():
    assert sum(len(c.not_null) for c in CHECKS.values()) == 57
    assert sum(len(c.unique) for c in CHECKS.values()) == 10
    assert sum(len(c.accepted) for c in CHECKS.values()) == 7


def test_duplicate_route_is_reported(frame):
    routes = frame("routes", [{"route_id": "r", "zone": "z", "district": "d", "total_stops": 3}] * 2)
    got = outcome(quality.report({"raw.routes": routes}, ["unique"]))
    assert got == {("raw.routes", "unique", "route_id"): (1, False)}


def test_gate(sample, spark):
    with pytest.raises(quality.QualityGateFailed, match="t.id unique: 2"):
        quality.gate(quality.report({"t": sample}, registry=CHECK))
    good = spark.createDataFrame([("a", "light", 1)], "id string, class string, n int")
    assert len(quality.gate(quality.report({"t": good}, registry=CHECK))) == 6


def test_row_checks_take_one_pass(sample):
    plan = quality.row_checks(sample, [("t", CHECK["t"], F.lit(True)), ("v", CHECK["t"], F.col("n") > 0)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_required_columns(frame):
    for table, required in REQUIRED_COLUMNS.items():
        name = table.split(".")[1]
        assert quality.missing_columns(frame(name, []), required) == set()
        assert set(required) <= set(TABLES[name].names)
    assert quality.missing_columns(frame("routes", []).drop("zone"), ["zone", "route_id"]) == {"zone"}


def test_row_counts(sample):
    assert [tuple(r) for r in quality.row_counts({"t": sample}).collect()] == [("t", 7)]


def test_a_view_is_checked_with_its_table(sample):
    """The same counts as for the filtered rows by themselves, NULL conditions being no rows of the view."""
    registry = CHECK | {"v": CHECK["t"]}
    together = quality.report({"t": sample}, registry=registry, views={"v": ("t", F.col("n") > 0)})
    apart = quality.report({"t": sample, "v": sample.where("n > 0")}, registry=registry)
    assert outcome(together) == outcome(apart)
