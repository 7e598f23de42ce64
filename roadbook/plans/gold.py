"""Gold: the three marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.functions import fleet
from roadbook.functions.exact import long_total, ratio, units
from roadbook.plans.silver import MILE_DECIMALS


def mart_route_efficiency(segments: DataFrame) -> DataFrame:
    """Route x day. ``avg_idle_pct`` is the share of pings, not of time."""
    daily = (
        segments
        .groupBy("route_id", "route_name", "zone", "district",
                 F.col("event_date").alias("segment_date"))
        .agg(
            F.count_distinct("vehicle_id").alias("vehicles_on_route"),
            F.sum(units("speed_mph")).alias("speed_units"),
            F.count("speed_mph").alias("speed_count"),
            long_total("segment_distance_miles", MILE_DECIMALS).alias("miles"),
            F.sum(F.col("idle_flag").cast("bigint")).alias("idle_count"),
            F.count(F.lit(1)).alias("total_events"),
        )
    )
    return daily.select(
        "route_id", "route_name", "zone", "district", "segment_date", "vehicles_on_route",
        ratio(F.col("speed_units"), F.col("speed_count") * 100).alias("avg_speed"),
        ratio(F.col("miles"), F.lit(10 ** (MILE_DECIMALS - 4)), 4).alias("total_miles"),
        ratio(F.col("idle_count") * 10_000, F.col("total_events")).alias("avg_idle_pct"),
        "total_events",
        fleet.efficiency_score(F.col("speed_units"), F.col("speed_count"),
                               F.col("idle_count"), F.col("total_events"))
        .alias("efficiency_score"),
    )


def service_history(maintenance: DataFrame, as_of: date) -> DataFrame:
    """Per vehicle: last service, cost in the calendar year of ``as_of``, events."""
    this_year = F.year("service_date") == as_of.year
    return maintenance.groupBy("vehicle_id").agg(
        F.max("service_date").alias("last_service_date"),
        F.sum(F.when(this_year, units("cost_usd")).otherwise(F.lit(0))).alias("cost_units"),
        F.count(F.lit(1)).alias("total_service_events"),
    )


def mart_fleet_health(vehicles: DataFrame, maintenance: DataFrame, as_of: date) -> DataFrame:
    """One row a vehicle; a vehicle never serviced keeps NULLs and low urgency."""
    days = fleet.days_since(F.col("last_service_date"), as_of)
    return vehicles.join(service_history(maintenance, as_of), "vehicle_id", "left").select(
        "vehicle_id", "make", "model", "year", "vehicle_class", "status", "last_service_date",
        days.alias("days_since_service"),
        ratio(F.col("cost_units"), F.lit(100)).alias("total_cost_ytd"),
        "total_service_events",
        fleet.urgency(days).alias("maintenance_urgency"),
    )


def mart_driver_performance(daily: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Vehicle x month over the rounded daily figures; each day weighs the same."""
    monthly = (
        daily
        .groupBy("vehicle_id", F.trunc("event_date", "MM").alias("month"))
        .agg(
            F.sum(units("avg_speed_mph", 2)).alias("speed_cents"),
            F.count("avg_speed_mph").alias("speed_days"),
            F.sum(units("idle_pct", 2)).alias("idle_cents"),
            F.count("idle_pct").alias("idle_days"),
            F.sum(units("total_miles", 4)).alias("mile_units"),
            F.sum("trips_count").alias("total_trips"),
            F.sum(units("total_active_mins", 2)).alias("active_cents"),
            F.count("total_active_mins").alias("active_mins_days"),
            F.count_distinct("event_date").alias("active_days"),
        )
    )
    named = vehicles.select("vehicle_id", "make", "model", "vehicle_class")
    return monthly.join(named, "vehicle_id", "left").select(
        "vehicle_id", "make", "model", "vehicle_class", "month",
        ratio(F.col("speed_cents"), F.col("speed_days")).alias("avg_speed"),
        ratio(F.col("idle_cents"), F.col("idle_days")).alias("idle_pct"),
        ratio(F.col("mile_units"), F.lit(100)).alias("total_miles"),
        "total_trips",
        "active_days",
        ratio(F.col("active_cents"), F.col("active_mins_days"))
        .alias("avg_active_mins_per_day"),
        fleet.safety_score(F.col("speed_cents"), F.col("speed_days"),
                           F.col("idle_cents"), F.col("idle_days")).alias("safety_score"),
    )
