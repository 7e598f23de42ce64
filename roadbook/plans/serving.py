"""Queries served from the marts: the dashboard's and the five verified ones.

NULLs sort as the largest value (last ascending, first descending), spelled
out everywhere, and each order ends in a key so a top-k is the same every time.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook import settings as S
from roadbook.functions.exact import mean, ratio, total, units


def descending(column: str, *keys: str) -> list[Column]:
    return [F.col(column).desc_nulls_first(), *[F.col(k).asc_nulls_last() for k in keys]]


def ascending(column: str, *keys: str) -> list[Column]:
    return [F.col(column).asc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]]


def only(df: DataFrame, column: str, selected: list[str] | None) -> DataFrame:
    """Keep the selected values; an empty selection keeps everything."""
    return df.where(F.col(column).isin(list(selected))) if selected else df


def existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that the frame has, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


# verified queries

ROUTE = ["route_id", "route_name", "zone"]


def top_idle_routes_last_week(efficiency: DataFrame, as_of: date) -> DataFrame:
    recent = efficiency.where(F.col("segment_date") >= F.lit(as_of - timedelta(days=7)))
    return (recent.groupBy(*ROUTE).agg(mean("avg_idle_pct", 2).alias("avg_idle_pct"))
            .orderBy(*descending("avg_idle_pct", *ROUTE)).limit(S.TOP_K))


def vehicles_overdue_maintenance(health: DataFrame) -> DataFrame:
    return (health.where(F.col("maintenance_urgency").isin("medium", "high"))
            .select("vehicle_id", "make", "model", "vehicle_class", "last_service_date",
                    "days_since_service", "maintenance_urgency")
            .orderBy(*descending("days_since_service", "vehicle_id")))


def avg_speed_by_zone(efficiency: DataFrame) -> DataFrame:
    return (efficiency.groupBy("zone").agg(mean("avg_speed", 2).alias("avg_speed_mph"))
            .orderBy(*descending("avg_speed_mph", "zone")))


def monthly_fleet_cost(health: DataFrame) -> DataFrame:
    """Cost of the calendar year by class, whatever the name says."""
    return (health.groupBy("vehicle_class").agg(total("total_cost_ytd", 2).alias("total_cost_usd"))
            .orderBy(*descending("total_cost_usd", "vehicle_class")))


def lowest_efficiency_routes(efficiency: DataFrame, as_of: date) -> DataFrame:
    this_month = efficiency.where(F.col("segment_date") >= F.lit(as_of.replace(day=1)))
    return (this_month.groupBy(*ROUTE).agg(mean("efficiency_score", 2).alias("avg_efficiency"))
            .orderBy(*ascending("avg_efficiency", *ROUTE)).limit(S.TOP_K))


# dashboard

def default_window(as_of: date) -> tuple[date, date]:
    return as_of - timedelta(days=S.DASHBOARD_DAYS), as_of


def route_options(efficiency: DataFrame) -> DataFrame:
    return efficiency.select("route_id").distinct().orderBy(F.col("route_id").asc_nulls_last())


def default_routes(efficiency: DataFrame) -> list[str]:
    """The routes selected when the page opens."""
    return [r.route_id for r in route_options(efficiency).limit(S.DEFAULT_ROUTE_COUNT).collect()]


def efficiency_rows(efficiency: DataFrame, start: date, end: date,
                    routes: list[str] | None = None) -> DataFrame:
    chosen = only(efficiency.where(F.col("segment_date").between(F.lit(start), F.lit(end))),
                  "route_id", routes)
    return chosen.select(
        "segment_date", "route_id", "zone", "avg_speed", "avg_idle_pct", "total_miles",
        "vehicles_on_route", "efficiency_score",
    ).orderBy(*ascending("segment_date", "route_id"))


# The published columns of the view.
HEALTH_COLUMNS = ["vehicle_id", "make", "model", "vehicle_class", "status", "last_service_date",
                  "days_since_service", "total_cost_ytd", "maintenance_urgency"]


def fleet_health_rows(health: DataFrame, classes: list[str] | None = None) -> DataFrame:
    return (existing(only(health, "vehicle_class", classes), HEALTH_COLUMNS)
            .orderBy(*descending("days_since_service", "vehicle_id")))


def kpis(efficiency: DataFrame, health: DataFrame) -> DataFrame:
    """One row: active routes, mean speed, share of active vehicles, open alerts."""
    speeds = F.count("avg_speed")
    routes = efficiency.agg(
        F.count_distinct("route_id").alias("active_routes"),
        F.coalesce(ratio(F.sum(units("avg_speed", 2)), speeds * 10, 1), F.lit(0.0))
        .alias("avg_speed"),
    )
    active = F.count_if(F.col("status") == "active")
    fleet = health.agg(
        F.coalesce(ratio(active * 1_000, F.count(F.lit(1)), 1), F.lit(0.0))
        .alias("fleet_utilisation"),
        F.count_if(F.col("maintenance_urgency").isin("medium", "high"))
        .alias("maintenance_alerts"),
    )
    both = routes.unionByName(fleet, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def daily_trend(efficiency: DataFrame) -> DataFrame:
    return (efficiency.groupBy("segment_date")
            .agg(mean("avg_speed", 2).alias("avg_speed"),
                 mean("avg_idle_pct", 2).alias("avg_idle_pct"))
            .orderBy(F.col("segment_date").asc_nulls_last()))


def urgency_counts(health: DataFrame) -> DataFrame:
    """Vehicles per urgency level, in level order, 0 for a level nobody has."""
    levels = health.agg(F.array(*[
        F.struct(F.lit(i).alias("level_order"), F.lit(level).alias("urgency"),
                 F.count_if(F.col("maintenance_urgency") == level).alias("vehicles"))
        for i, level in enumerate(S.URGENCY_LEVELS)
    ]).alias("levels"))
    return levels.select(F.inline("levels")).orderBy("level_order").select("urgency", "vehicles")


def top_urgent(health: DataFrame) -> DataFrame:
    return (health.where(F.col("maintenance_urgency") == "high")
            .select("vehicle_id", "make", "model", "days_since_service", "maintenance_urgency")
            .orderBy(*descending("days_since_service", "vehicle_id")).limit(S.TOP_K))
