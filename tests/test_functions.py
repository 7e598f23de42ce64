from __future__ import annotations

from datetime import date, datetime
from fractions import Fraction
from math import asin, cos, floor, radians, sin, sqrt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadbook.functions import exact, fleet


def test_ratio_rounds_ties_away_from_zero(spark):
    rows = [(4837, 1200), (1, 8), (-1, 8), (4839, 12), (-4839, 12), (0, 7), (5, 0), (None, 3), (5, None)]
    df = spark.createDataFrame(rows, "n bigint, d bigint")
    got = [r[0] for r in df.select(exact.ratio(F.col("n") * 100, F.col("d"))).collect()]
    assert got == [4.03, 0.13, -0.13, 403.25, -403.25, 0.0, None, None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)),
                min_size=50, max_size=50))
def test_ratio_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "n bigint, d bigint")
    got = [r[0] for r in df.select(exact.half_away(F.col("n"), F.col("d"))).collect()]
    def rounded(n, d):
        q = floor(Fraction(abs(n), d) + Fraction(1, 2))
        return q if n >= 0 else -q
    assert got == [rounded(n, d) for n, d in rows]


def test_sums_do_not_depend_on_order(spark):
    values = [(i % 801 / 10.0,) for i in range(5000)]
    for parts in (1, 7):
        df = spark.createDataFrame(values, "v double").repartition(parts)
        assert df.agg(exact.total("v", 1)).first()[0] == sum(i % 801 for i in range(5000)) / 10


def test_long_total(spark):
    values = [12_000.123456789, -3.5, 0.000000001, None, 1e-10, 7.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(exact.long_total("v", 9)).first()[0] == 12_003_623_456_790
    assert df.where("v is null").agg(exact.long_total("v", 9)).first()[0] is None


def test_long_total_does_not_overflow(spark):
    df = spark.range(2000).select((F.lit(9e6) + F.col("id") * 0).alias("v"))
    assert df.agg(exact.long_total("v", 9)).first()[0] == 2000 * 9 * 10**15


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert df.agg(exact.mean("v", 2), exact.total("v", 2)).first() == (None, None)


def efficiency(spark, speeds: list[float | None], idle: int):
    units = None if all(s is None for s in speeds) else sum(round(s * 10_000) for s in speeds if s is not None)
    count = sum(s is not None for s in speeds)
    df = spark.createDataFrame([(units, count, idle, len(speeds))], "s bigint, m bigint, k bigint, n bigint")
    return df.select(fleet.efficiency_score(*[F.col(c) for c in "smkn"])).first()[0]


def test_efficiency_known_values(spark):
    assert efficiency(spark, [30.0] * 5, 1) == 88.5
    assert efficiency(spark, [40.0] * 4, 0) == 100.0
    assert efficiency(spark, [0.0] * 4, 4) == 39.5


def test_efficiency_clips(spark):
    assert efficiency(spark, [-400.0], 1) == 0.0


def test_efficiency_of_unknown_speed(spark):
    assert efficiency(spark, [None], 0) is None
    # idle share over all pings, average speed over the known ones
    assert efficiency(spark, [25.0, None], 0) == 97.0


def test_high_idle_lowers_efficiency(spark):
    assert efficiency(spark, [0.0] * 2, 2) < efficiency(spark, [40.0] * 2, 0)


def test_efficiency_survives_huge_groups(spark):
    n = 300_000_000_000
    df = spark.createDataFrame([(n * 300_000, n, n // 5, n)], "s bigint, m bigint, k bigint, n bigint")
    assert df.select(fleet.efficiency_score(*[F.col(c) for c in "smkn"])).first()[0] == 88.5


@pytest.mark.parametrize(("speed", "idle", "expected"), [
    (4500, 0, 90.0), (9000, 0, 90.0), (0, 10000, 40.0), (2250, 1000, 77.0), (-90000, 10000, 0.0),
])
def test_safety(spark, speed, idle, expected):
    df = spark.createDataFrame([(speed, 1, idle, 1)], "s bigint, a bigint, i bigint, b bigint")
    assert df.select(fleet.safety_score(*[F.col(c) for c in "saib"])).first()[0] == expected


def test_safety_of_unknown_speed(spark):
    df = spark.createDataFrame([(None, 0, 100, 1)], "s bigint, a bigint, i bigint, b bigint")
    assert df.select(fleet.safety_score(*[F.col(c) for c in "saib"])).first()[0] is None


def test_urgency_boundaries(spark):
    days = [0, 30, 60, 61, 75, 90, 91, 100, 365, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    assert [r[0] for r in df.select(fleet.urgency(F.col("d"))).collect()] == (
        ["low"] * 3 + ["medium"] * 3 + ["high"] * 3 + ["low"])


def test_idle_flag(spark):
    df = spark.createDataFrame([(4.9,), (5.0,), (None,)], "s double")
    assert [r[0] for r in df.select(fleet.idle_flag(F.col("s"))).collect()] == [1, 0, 0]


def test_elapsed_counts_second_boundaries(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 900_000), datetime(2024, 1, 1, 0, 0, 2, 100_000)),
            (None, datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    seconds = fleet.elapsed_seconds(F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(seconds).collect()] == [2, None]


def test_elapsed_ignores_the_session_zone(spark):
    # clocks in Chicago skip an hour between these two
    df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        assert df.select(fleet.elapsed_seconds(F.col("a"), F.col("b"))).first()[0] == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_haversine(spark):
    a, b = (29.76, -95.37), (30.05, -95.71)
    df = spark.createDataFrame([(*a, *b)], "a double, b double, c double, d double")
    got = df.select(fleet.haversine_miles(*[F.col(c) for c in "abcd"])).first()[0]
    h = (sin(radians((b[0] - a[0]) / 2)) ** 2
         + cos(radians(a[0])) * cos(radians(b[0])) * sin(radians((b[1] - a[1]) / 2)) ** 2)
    assert got == pytest.approx(2 * 3958.8 * asin(sqrt(h)), abs=1e-9)


def test_box_is_inclusive(spark):
    rows = [(29.5, -95.8), (30.1, -95.1), (29.49, -95.5), (30.0, -95.09), (None, -95.5), (29.7, None)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    assert df.where(fleet.inside_box()).count() == 2


def test_days_since(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (None,)], "d date")
    days = fleet.days_since(F.col("d"), date(2024, 1, 31))
    assert [r[0] for r in df.select(days).collect()] == [30, None]
