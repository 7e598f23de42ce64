"""The declared checks of every table."""

from __future__ import annotations

from dataclasses import dataclass, field

from roadbook import settings as S


@dataclass(frozen=True)
class Checks:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    # column -> inclusive (low, high); None leaves a side open
    ranges: dict[str, tuple] = field(default_factory=dict)
    positive: list[str] = field(default_factory=list)


_CLASS = {"vehicle_class": S.VEHICLE_CLASSES}
_CLASS_STATUS = {"vehicle_class": S.VEHICLE_CLASSES, "status": S.VEHICLE_STATUSES}

# 57 not-null, 10 unique and 7 accepted-values checks, then ranges.
CHECKS: dict[str, Checks] = {
    "raw.routes": Checks(
        not_null=["route_id", "zone", "district"],
        unique=["route_id"],
        positive=["total_stops"]),
    "raw.vehicles": Checks(
        not_null=["vehicle_id"],
        unique=["vehicle_id"],
        accepted=_CLASS_STATUS,
        ranges={"year": (2010, 2025)}),
    "raw.gps_events": Checks(
        not_null=["event_id", "vehicle_id", "route_id", "speed_mph"],
        unique=["event_id"]),
    "raw.maintenance_logs": Checks(
        not_null=["log_id", "vehicle_id", "cost_usd"],
        unique=["log_id"],
        positive=["cost_usd", "mileage_at_service"]),
    "silver.stg_routes": Checks(
        not_null=["route_id", "zone", "district", "total_stops"],
        unique=["route_id"]),
    "silver.stg_vehicles": Checks(
        not_null=["vehicle_id", "vehicle_class", "status"],
        unique=["vehicle_id"],
        accepted=_CLASS_STATUS),
    "silver.stg_gps_events": Checks(
        not_null=["event_id", "vehicle_id", "route_id", "lat", "lon", "speed_mph", "event_date"],
        unique=["event_id"],
        ranges={"lat": (S.LAT_MIN, S.LAT_MAX), "lon": (S.LON_MIN, S.LON_MAX),
                "speed_mph": (0, 120)}),
    "silver.stg_maintenance": Checks(
        not_null=["log_id", "vehicle_id", "service_type", "service_date", "cost_usd"],
        unique=["log_id"]),
    "silver.int_route_segments": Checks(
        not_null=["event_id", "vehicle_id", "route_id", "event_date", "speed_mph",
                  "segment_distance_miles"],
        unique=["event_id"],
        accepted={"idle_flag": [0, 1]}),
    "silver.int_vehicle_daily_stats": Checks(
        not_null=["vehicle_id", "event_date", "trips_count", "total_miles", "idle_pct"]),
    "gold.mart_route_efficiency": Checks(
        not_null=["route_id", "segment_date", "avg_speed", "total_miles", "avg_idle_pct",
                  "vehicles_on_route", "efficiency_score"],
        ranges={"efficiency_score": (0, 100)}),
    "gold.mart_fleet_health": Checks(
        not_null=["vehicle_id", "vehicle_class", "maintenance_urgency"],
        unique=["vehicle_id"],
        accepted={**_CLASS, "maintenance_urgency": S.URGENCY_LEVELS}),
    "gold.mart_driver_performance": Checks(
        not_null=["vehicle_id", "month", "avg_speed", "idle_pct", "total_miles", "safety_score"],
        ranges={"safety_score": (0, 100)}),
}

# What a consumer may rely on being there.
# The columns that each landed table must have.
REQUIRED_COLUMNS: dict[str, list[str]] = {
    "raw.routes": ["route_id", "route_name", "zone", "district", "total_stops", "created_at"],
    "raw.vehicles": ["vehicle_id", "make", "model", "year", "vehicle_class", "status"],
    "raw.gps_events": ["event_id", "vehicle_id", "route_id", "lat", "lon", "speed_mph",
                       "event_ts", "event_date"],
    "raw.maintenance_logs": ["log_id", "vehicle_id", "service_type", "service_date", "cost_usd",
                             "mileage_at_service"],
}
