"""The named queries, wired to the test tables.

Each takes ``(spark, sf_dir)`` and builds a DataFrame over whole tables; building one starts no job.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook import fixtures
from roadbook.checks import keys, quality
from roadbook.functions import fleet
from roadbook.operators import distinct, rejects, staging
from roadbook.plans import gold, metrics, serving, silver
from roadbook.sources import landing, multiline

# The test tables' fixed "today": service logs end in 2001, pings in January 2024.
HEALTH_AS_OF = date(2001, 8, 15)
EFFICIENCY_AS_OF = date(2024, 1, 30)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# staging

@query
def stg_routes(spark, sf_dir):
    return staging.stg_routes(fixtures.routes(spark, sf_dir))


@query
def stg_vehicles(spark, sf_dir):
    return staging.stg_vehicles(fixtures.vehicles(spark, sf_dir))


@query
def stg_maintenance(spark, sf_dir):
    return staging.stg_maintenance(fixtures.maintenance_logs(spark, sf_dir))


@query
def stg_gps_events(spark, sf_dir):
    return staging.stg_gps_events(fixtures.gps_events(spark, sf_dir))


# silver

@query
def gps_lag_features(spark, sf_dir):
    return silver.lag_features(stg_gps_events(spark, sf_dir)).select(
        "event_id", "vehicle_id", "route_id", "event_date", "event_ts",
        "prev_lat", "prev_lon", "prev_ts")


@query
def haversine_miles(spark, sf_dir):
    lagged = silver.lag_features(stg_gps_events(spark, sf_dir))
    miles = fleet.haversine_miles(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    return lagged.select("event_id", F.round(miles, 9).alias("miles"))


@query
def segments_enriched(spark, sf_dir):
    pings = stg_gps_events(spark, sf_dir)
    return silver.with_route(pings, stg_routes(spark, sf_dir)).select(
        "event_id", "vehicle_id", "route_id", "route_name", "zone", "district", "event_ts")


def _segments(spark, sf_dir):
    return silver.int_route_segments(stg_gps_events(spark, sf_dir), stg_routes(spark, sf_dir))


@query
def int_route_segments(spark, sf_dir):
    # nine decimals: two math libraries may differ in the last bit of a sine
    miles = F.round("segment_distance_miles", 9)
    return _segments(spark, sf_dir).withColumn("segment_distance_miles", miles)


@query
def int_vehicle_daily_stats(spark, sf_dir):
    return silver.int_vehicle_daily_stats(_segments(spark, sf_dir))


# gold

@query
def mart_route_efficiency(spark, sf_dir):
    return gold.mart_route_efficiency(_segments(spark, sf_dir))


@query
def mart_fleet_health(spark, sf_dir):
    return gold.mart_fleet_health(stg_vehicles(spark, sf_dir), stg_maintenance(spark, sf_dir),
                                  HEALTH_AS_OF)


@query
def mart_driver_performance(spark, sf_dir):
    return gold.mart_driver_performance(int_vehicle_daily_stats(spark, sf_dir),
                                        stg_vehicles(spark, sf_dir))


@query
def efficiency_score(spark, sf_dir):
    return mart_route_efficiency(spark, sf_dir).select("route_id", "segment_date",
                                                       "efficiency_score")


@query
def safety_score(spark, sf_dir):
    return mart_driver_performance(spark, sf_dir).select("vehicle_id", "month", "safety_score")


@query
def urgency_bucket(spark, sf_dir):
    days = fleet.days_since(F.col("service_date"), HEALTH_AS_OF)
    return stg_maintenance(spark, sf_dir).select("log_id", days.alias("days_since"),
                                                 fleet.urgency(days).alias("urgency"))


@query
def null_scores(spark, sf_dir):
    """Scores of routes by day and vehicles by month where some have no speed: NULL in, NULL out."""
    segments = silver.int_route_segments(staging.stg_gps_events(fixtures.pings_without_speeds(spark, sf_dir)), stg_routes(spark, sf_dir))
    routes = gold.mart_route_efficiency(segments)
    vehicles = gold.mart_driver_performance(silver.int_vehicle_daily_stats(segments), stg_vehicles(spark, sf_dir))
    return routes.select(F.col("route_id").alias("id"), F.col("segment_date").alias("period"), F.col("efficiency_score").alias("score")).union(
        vehicles.select("vehicle_id", "month", "safety_score"))


@query
def distinct_vehicles_by_zone_month(spark, sf_dir):
    """Merged from the states of days; the mart's own vehicles_on_route keeps its published sum."""
    pings = silver.with_route(stg_gps_events(spark, sf_dir), stg_routes(spark, sf_dir))
    numbered = distinct.numbers(stg_gps_events(spark, sf_dir), "vehicle_id")
    daily = distinct.states(pings, numbered, "vehicle_id", ["zone", "event_date"])
    monthly = distinct.merged(daily, ["zone", F.trunc("event_date", "MM").alias("month")])
    return distinct.counts(monthly, ["zone", "month"], "vehicles")


# verified queries

@query
def vq_top_idle_routes_last_week(spark, sf_dir):
    return serving.top_idle_routes_last_week(mart_route_efficiency(spark, sf_dir), EFFICIENCY_AS_OF)


@query
def vq_vehicles_overdue_maintenance(spark, sf_dir):
    return serving.vehicles_overdue_maintenance(mart_fleet_health(spark, sf_dir))


@query
def vq_avg_speed_by_zone(spark, sf_dir):
    return serving.avg_speed_by_zone(mart_route_efficiency(spark, sf_dir))


@query
def vq_monthly_fleet_cost(spark, sf_dir):
    return serving.monthly_fleet_cost(mart_fleet_health(spark, sf_dir))


@query
def vq_lowest_efficiency_routes(spark, sf_dir):
    return serving.lowest_efficiency_routes(mart_route_efficiency(spark, sf_dir), EFFICIENCY_AS_OF)


@query
def question_speed_by_zone(spark, sf_dir):
    """A verified query by the words of its question."""
    return metrics.answer("What is the average speed by route zone?", {"mart_route_efficiency": mart_route_efficiency(spark, sf_dir)},
                          EFFICIENCY_AS_OF)


# dashboard

@query
def dash_route_options(spark, sf_dir):
    return serving.route_options(mart_route_efficiency(spark, sf_dir))


@query
def dash_efficiency(spark, sf_dir):
    return serving.efficiency_rows(mart_route_efficiency(spark, sf_dir),
                                   *serving.default_window(EFFICIENCY_AS_OF))


@query
def dash_fleet_health(spark, sf_dir):
    return serving.fleet_health_rows(mart_fleet_health(spark, sf_dir), ["light", "medium", "heavy"])


@query
def dash_absent_columns(spark, sf_dir):
    """The view of a mart that lacks some of its columns: those that are there."""
    return serving.fleet_health_rows(mart_fleet_health(spark, sf_dir).drop("make", "status"))


@query
def dash_selected_classes(spark, sf_dir):
    return serving.fleet_health_rows(mart_fleet_health(spark, sf_dir), ["heavy", "light"])


@query
def dash_selected_routes(spark, sf_dir):
    return serving.efficiency_rows(mart_route_efficiency(spark, sf_dir),
                                   *serving.default_window(EFFICIENCY_AS_OF), ["RT-0002", "RT-0026", "RT-0005"])


@query
def dash_kpis(spark, sf_dir):
    return serving.kpis(dash_efficiency(spark, sf_dir), mart_fleet_health(spark, sf_dir))


@query
def dash_daily_trend(spark, sf_dir):
    return serving.daily_trend(dash_efficiency(spark, sf_dir))


@query
def dash_urgency_counts(spark, sf_dir):
    return serving.urgency_counts(mart_fleet_health(spark, sf_dir))


@query
def dash_top_urgent(spark, sf_dir):
    return serving.top_urgent(mart_fleet_health(spark, sf_dir))


# metric layer

@query
def metric_by_zone(spark, sf_dir):
    marts = {"mart_route_efficiency": mart_route_efficiency(spark, sf_dir)}
    return metrics.metric_query(marts, "mart_route_efficiency", ["zone"], [
        "avg_speed", "total_miles", "avg_idle_pct", "vehicles_on_route", "efficiency_score"])


@query
def metric_by_vehicle_class(spark, sf_dir):
    marts = {"mart_fleet_health": mart_fleet_health(spark, sf_dir)}
    return metrics.metric_query(marts, "mart_fleet_health", ["vehicle_class"],
                                ["days_since_service", "total_cost_ytd"])


@query
def metric_by_month(spark, sf_dir):
    marts = {"mart_driver_performance": mart_driver_performance(spark, sf_dir)}
    return metrics.metric_query(marts, "mart_driver_performance", ["month"],
                                ["avg_speed", "idle_pct", "total_miles", "safety_score"])


@query
def metric_where(spark, sf_dir):
    marts = {"mart_route_efficiency": mart_route_efficiency(spark, sf_dir)}
    return metrics.metric_query(marts, "mart_route_efficiency", ["zone"], ["avg_speed", "vehicles_on_route"],
                                where={"zone": ["ASIA", "EUROPE"], "segment_date": (date(2024, 1, 5), date(2024, 1, 20))})


@query
def metric_groupings(spark, sf_dir):
    """Four groupings of one mart in one pass."""
    marts = {"mart_route_efficiency": mart_route_efficiency(spark, sf_dir)}
    return metrics.metric_groupings(marts, "mart_route_efficiency", [
        (["zone"], ["avg_speed", "total_miles"]), (["district"], ["efficiency_score"]),
        (["zone", "district"], ["avg_speed", "vehicles_on_route"]), ([], ["total_miles", "efficiency_score"])])


# data quality

def _checked(spark, sf_dir):
    """Every checked table but the staged views, from raw tables with something wrong of every kind."""
    raw = fixtures.dirty(spark, sf_dir)
    routes, vehicles = staging.stg_routes(raw["routes"]), staging.stg_vehicles(raw["vehicles"])
    gps, maintenance = staging.stg_gps_events(raw["gps_events"]), staging.stg_maintenance(raw["maintenance_logs"])
    segments = silver.int_route_segments(gps, routes)
    daily = silver.int_vehicle_daily_stats(segments)
    return {
        **{f"raw.{name}": raw[name] for name in ("routes", "vehicles", "gps_events", "maintenance_logs")},
        "silver.int_route_segments": segments,
        "silver.int_vehicle_daily_stats": daily,
        "gold.mart_route_efficiency": gold.mart_route_efficiency(segments),
        "gold.mart_fleet_health": gold.mart_fleet_health(vehicles, maintenance, HEALTH_AS_OF),
        "gold.mart_driver_performance": gold.mart_driver_performance(daily, vehicles),
    }


@query
def dq_not_null(spark, sf_dir):
    return quality.report(_checked(spark, sf_dir), ["not_null"], views=staging.views())


@query
def dq_unique(spark, sf_dir):
    return quality.report(_checked(spark, sf_dir), ["unique"], views=staging.views())


@query
def dq_accepted_values(spark, sf_dir):
    return quality.report(_checked(spark, sf_dir), ["accepted_values"], views=staging.views())


@query
def dq_range(spark, sf_dir):
    return quality.report(_checked(spark, sf_dir), ["range", "positive"], views=staging.views())


@query
def dq_report(spark, sf_dir):
    return quality.report(_checked(spark, sf_dir), views=staging.views())


@query
def dq_unique_after_reload(spark, sf_dir):
    """Uniqueness of pings after one of three batches has been replaced, by the keys that it touches."""
    pings, again = fixtures.reloaded_pings(spark, sf_dir)
    views = staging.views()
    parts = [F.lit(True), F.coalesce(views["silver.stg_gps_events"][1], F.lit(False))]
    stored, new = keys.key_rows(pings, "event_id", "unit", parts), keys.key_rows(again, "event_id", "unit", parts)
    old, rest = stored.where("unit = 1"), stored.where("unit <> 1")
    added = keys.added_repeats(rest, old, new, keys.touched_keys(old, new), 2)
    # what a ledger would hold already: nothing was there before the three batches
    none = stored.limit(0)
    before = keys.added_repeats(none, none, stored, keys.touched_keys(none, stored), 2)
    both = before.union(added).agg(F.sum("r0").alias("r0"), F.sum("r1").alias("r1"))
    return both.select(F.inline(F.array(
        F.struct(F.lit("raw.gps_events").alias("table_name"), F.col("r0").alias("failing_rows")),
        F.struct(F.lit("silver.stg_gps_events").alias("table_name"), F.col("r1").alias("failing_rows")))))


@query
def raw_row_counts(spark, sf_dir):
    return quality.row_counts({t: build(spark, sf_dir) for t, build in fixtures.RAW.items()})


# ingest

def _parsed(spark, sf_dir):
    return rejects.parse(landing.read_lines(fixtures.dirty_gps_lines(spark, sf_dir), "gps_events"), "gps_events")


@query
def ingest_csv_clean(spark, sf_dir):
    return rejects.accepted(_parsed(spark, sf_dir))


@query
def ingest_csv_rejects(spark, sf_dir):
    bad = rejects.rejected(_parsed(spark, sf_dir), "gps_events")
    text = F.from_json("_raw", "event_id string, speed_mph string, heading_deg string, event_ts string")
    return bad.select(text.alias("text"), "_reason").select(
        "text.*", F.col("_reason").alias("reason"))


@query
def ingest_csv_multiline(spark, sf_dir):
    """Service logs from lines of split files, notes with newlines and all."""
    rows = multiline.split_rows(fixtures.log_lines(spark, sf_dir)).withColumnRenamed("row", "line")
    return rejects.accepted(rejects.parse(landing.read_lines(rows, "maintenance_logs"), "maintenance_logs"))


@query
def ingest_load_summary(spark, sf_dir):
    return rejects.load_summary(_parsed(spark, sf_dir), "gps_events")
