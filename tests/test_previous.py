"""The lag over ranges must equal the plain definition, whatever the skew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from roadbook.operators import previous
from roadbook.operators.previous import with_previous, with_ranges
from roadbook.plans.silver import TRIP_KEYS, TRIP_ORDER, lag_features
from roadbook.schemas import TABLES

SCHEMA = "k string, g string, t int, id string, a double, b double"
KEYS, ORDER = ["k", "g"], ["t", "id", "a", "b"]


def lagged(df, **sizes):
    return with_previous(df, KEYS, ORDER, ["a", "b"], **sizes)


def brute_force(rows):
    """Previous (a, b) by all of t, id, a, b, NULLs last, within (k, g)."""
    groups: dict = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), []).append(r)
    out = []
    for members in groups.values():
        members.sort(key=lambda r: tuple((v is None, v or 0) if i != 1 else (False, v) for i, v in enumerate(r[2:])))
        for before, r in zip([None, *members], members):
            out.append((*r, before[4] if before else None, before[5] if before else None))
    return out


def skewed_rows(seed: int, n: int = 600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        key = "hot" if hot else rng.choice(["x", "y", "z", None])
        rows.append((key, "g" if hot else rng.choice(["g", "h", None]),
                     rng.choice([None, *range(40)]), f"{i // 3:05d}",
                     rng.choice([None, rng.random()]), float(i)))
    rng.shuffle(rows)
    return rows


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.mark.parametrize("sample, per_range, most", [(1, 1, 10**6), (1, 7, 10**6), (3, 2, 10**6), (1, 1, 5), (10**6, 1, 5)])
def test_matches_brute_force(spark, sample, per_range, most):
    """A range a row, ranges of some rows, a bounded number of ranges, none at all."""
    rows = skewed_rows(sample + per_range)
    got = lagged(spark.createDataFrame(rows, SCHEMA).repartition(5), sample=sample, per_range=per_range, most=most)
    assert got.columns == ["k", "g", "t", "id", "a", "b", "prev_a", "prev_b"]
    assert order(map(tuple, got.collect())) == order(brute_force(rows))


def test_the_number_of_ranges_is_bounded(spark):
    df = spark.createDataFrame(skewed_rows(9), SCHEMA)
    places = lambda **sizes: previous.range_starts(df, KEYS, ORDER, **sizes).agg(F.sum(F.size("_starts"))).first()[0]
    assert places(sample=1, per_range=1, most=10**6) > 500 and places(sample=1, per_range=1, most=20) <= 20


def test_ties_do_not_depend_on_the_files(spark):
    """Two files with pings of equal time and id: the order of the files changes nothing."""
    one, two = [("v", "r", 5, "e", 1.0, 2.0), ("v", "r", 5, "e", 3.0, 4.0)], [("v", "r", 5, "e", 2.0, 9.0), ("v", "r", 6, "f", 0.0, 0.0)]
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (one, two)]
    there, back = (order(map(tuple, lagged(a.union(b), sample=1, per_range=1).collect())) for a, b in (frames, frames[::-1]))
    assert there == back == order(brute_force(one + two))


def test_equal_rows_and_no_rows(spark):
    df = spark.createDataFrame([("v", "r", 1, "e", 1.0, 1.0)] * 50 + [("v", "r", 2, "e", 2.0, 2.0)] * 3, SCHEMA)
    for sizes in ({}, dict(sample=1, per_range=1)):
        got = sorted((r.a, r.prev_a is None, r.prev_a or 0.0) for r in lagged(df, **sizes).collect())
        assert got == [(1.0, False, 1.0)] * 49 + [(1.0, True, 0.0), (2.0, False, 1.0), (2.0, False, 2.0), (2.0, False, 2.0)]
        assert lagged(df.limit(0), **sizes).count() == 0


def spoilt(spark, n: int):
    """One trip of pings without a time, one with all in the same hour, and an ordinary one."""
    i = F.col("id")
    kind = i % 2
    return spark.range(n).select(
        F.concat(F.lit("E"), F.lpad(i.cast("string"), 9, "0")).alias("event_id"), F.when(i % 1000 == 0, "V0").otherwise(
            F.concat(F.lit("V"), (kind + 1).cast("string"))).alias("vehicle_id"),
        F.lit("R").alias("route_id"), (i * 7919 % 7001 / F.lit(1e4)).alias("lat"), (i % 5 * 1.0).alias("lon"), F.lit(1.0).alias("speed_mph"),
        F.lit(1).alias("heading_deg"),
        F.when(kind == 1, F.timestamp_seconds(F.lit(1_704_067_200) + i * 7919 % 3600).cast("timestamp_ntz")).alias("event_ts"),
        F.lit("2024-01-01").cast("date").alias("event_date")).select(*TABLES["gps_events"].names)


def test_a_trip_without_times_or_in_one_hour_is_spread(spark):
    """Two trips of 10**6 pings each are dealt over at least 8 tasks each, and their lag is the plain one."""
    pings = spoilt(spark, 2_000_000)
    ranges = with_ranges(pings, TRIP_KEYS, TRIP_ORDER).groupBy("vehicle_id", "_range").count().collect()
    for vehicle in ("V1", "V2"):
        sizes = [r["count"] for r in ranges if r.vehicle_id == vehicle]
        assert len(sizes) >= 8 and max(sizes) < 4 * sum(sizes) / len(sizes), sizes
    assert [r["count"] for r in ranges if r.vehicle_id == "V0"] == [2000]

    conf = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = lag_features(pings).select("vehicle_id", "event_id", "event_ts", "prev_ts", "prev_lat", F.spark_partition_id().alias("task")).cache()
        tasks = {r.vehicle_id: r.n for r in done.groupBy("vehicle_id").agg(F.count_distinct("task").alias("n"), F.max("prev_lat")).collect()}
        assert tasks["V1"] >= 8 and tasks["V2"] >= 8
        # each trip has one first ping; pings without a time follow their ids, of which each 1000th is another trip's
        firsts = {r.vehicle_id: r.event_id for r in done.where("prev_lat is null").collect()}
        assert len(firsts) == 3 == done.where("prev_lat is null").count()
        assert firsts["V0"] == "E000000000" and firsts["V1"] == "E000000002"
        assert done.where("prev_ts > event_ts").count() == 0
        untimed = done.where("vehicle_id = 'V1'").select(F.substring("event_id", 2, 9).cast("long").alias("i"), "prev_lat")
        before_it = F.when((F.col("i") - 2) % 1000 == 0, F.col("i") - 4).otherwise(F.col("i") - 2)
        assert untimed.where(F.col("i") > 2).where(F.col("prev_lat") != before_it * 7919 % 7001 / F.lit(1e4)).count() == 0
        done.unpersist()
    finally:
        for name, value in conf.items():
            spark.conf.set(name, value)


def test_one_full_shuffle_and_no_job_while_building(spark):
    """No count decides between plans; the window's exchange is the only one of all rows."""
    df = spark.createDataFrame(skewed_rows(1), SCHEMA)
    context = spark.sparkContext
    context.setJobGroup("lag", "building")
    plan = lagged(df)
    assert not context.statusTracker().getJobIdsForGroup("lag")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [lag(") == 2 and text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text
    lines = text.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
    assert len(exchanges) >= 4
    whole = [i for i in exchanges if "HashAggregate" not in lines[i + 1] and "SortAggregate" not in lines[i + 1]]
    assert len(whole) == 1 and "_range" in lines[whole[0]]
