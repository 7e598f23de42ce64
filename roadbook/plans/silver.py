"""Silver: pings enriched with their segment, and the vehicle-day roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.functions.exact import long_total, ratio, units
from roadbook.functions.fleet import elapsed_seconds, haversine_miles, idle_flag
from roadbook.operators.previous import previous_of_placed, with_previous

MILE_DECIMALS = 9  # a distance is summed in 10**-9 miles

TRIP_KEYS = ["vehicle_id", "route_id", "event_date"]
# the id settles equal timestamps, the position equal ids of two batches
TRIP_ORDER = ["event_ts", "event_id", "lat", "lon"]
CARRIED = ["lat", "lon", "event_ts"]


def lag_features(gps: DataFrame) -> DataFrame:
    """Each ping with the position and time of the one before it that day."""
    return with_previous(gps, TRIP_KEYS, TRIP_ORDER, CARRIED).withColumnRenamed("prev_event_ts", "prev_ts")


def lag_of_stored(trips: DataFrame) -> DataFrame:
    """The same for pings stored by their trips' ranges (``sources.trips``): no exchange before the window."""
    return previous_of_placed(trips, TRIP_KEYS, TRIP_ORDER, CARRIED).drop("_range", "_split").withColumnRenamed("prev_event_ts", "prev_ts")


def segment_distance() -> Column:
    """Miles since the previous ping; the first ping of a trip travelled nothing."""
    prev_lat, prev_lon = F.col("prev_lat"), F.col("prev_lon")
    return F.when(prev_lat.isNull(), 0.0).otherwise(
        haversine_miles(prev_lat, prev_lon, F.col("lat"), F.col("lon")))


def with_segments(lagged: DataFrame) -> DataFrame:
    return lagged.select(
        "event_id", "vehicle_id", "route_id", "lat", "lon", "speed_mph", "heading_deg",
        "event_ts", "event_date",
        segment_distance().alias("segment_distance_miles"),
        idle_flag(F.col("speed_mph")).alias("idle_flag"),
        (elapsed_seconds(F.col("prev_ts"), F.col("event_ts")) / F.lit(60.0)).alias("elapsed_mins"),
    )


def with_route(pings: DataFrame, routes: DataFrame) -> DataFrame:
    """Left join of the route attributes; pings of unknown routes stay.

    No broadcast hint: Spark broadcasts the routes when their measured size
    allows it, and otherwise AQE splits a hot route of the sorted join.
    """
    attributes = routes.select("route_id", "route_name", "zone", "district")
    return pings.join(attributes, "route_id", "left")


def int_route_segments(gps: DataFrame, routes: DataFrame) -> DataFrame:
    return segments_of_lagged(lag_features(gps), routes)


def segments_of_lagged(lagged: DataFrame, routes: DataFrame) -> DataFrame:
    return with_route(with_segments(lagged), routes).select(
        "event_id", "vehicle_id", "route_id", "route_name", "zone", "district",
        "lat", "lon", "speed_mph", "heading_deg", "event_ts", "event_date",
        "segment_distance_miles", "idle_flag", "elapsed_mins")


def int_vehicle_daily_stats(segments: DataFrame) -> DataFrame:
    # back to whole seconds: the minutes are seconds / 60
    seconds = F.floor(F.col("elapsed_mins") * F.lit(60.0) + F.lit(0.5))
    daily = (
        segments
        .select("vehicle_id", "event_date", "route_id", "speed_mph", "segment_distance_miles",
                "idle_flag", seconds.alias("seconds"))
        .groupBy("vehicle_id", "event_date")
        .agg(
            F.count_distinct("route_id").alias("trips_count"),
            long_total("segment_distance_miles", MILE_DECIMALS).alias("miles"),
            F.sum(units("speed_mph")).alias("speed_units"),
            F.count("speed_mph").alias("speed_count"),
            F.sum(F.when(F.col("idle_flag") == 1, F.col("seconds")).otherwise(F.lit(0)))
            .alias("idle_seconds"),
            F.sum("seconds").alias("active_seconds"),
            F.count(F.lit(1)).alias("event_count"),
        )
    )
    idle, active = F.col("idle_seconds"), F.col("active_seconds")
    return daily.select(
        "vehicle_id",
        "event_date",
        "trips_count",
        ratio(F.col("miles"), F.lit(10 ** (MILE_DECIMALS - 4)), 4).alias("total_miles"),
        ratio(F.col("speed_units"), F.col("speed_count") * 100).alias("avg_speed_mph"),
        ratio(idle * 100, F.lit(60)).alias("total_idle_mins"),
        ratio(active * 100, F.lit(60)).alias("total_active_mins"),
        F.when(active > 0, ratio(idle * 10_000, active)).otherwise(0.0).alias("idle_pct"),
        "event_count",
    )
