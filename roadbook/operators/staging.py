"""Staging: the declared columns, cast to their declared types; nothing is copied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.functions.fleet import inside_box
from roadbook.schemas import TABLES


def stage(raw: DataFrame, table: str) -> DataFrame:
    spec = TABLES[table]
    kept = [F.col(c.name).cast(c.type).alias(c.name) for c in spec.columns]
    if "_loaded_at" in raw.columns:
        kept.append(F.col("_loaded_at"))
    return raw.select(*kept)


def stg_routes(raw: DataFrame) -> DataFrame:
    return stage(raw, "routes")


def stg_vehicles(raw: DataFrame) -> DataFrame:
    return stage(raw, "vehicles")


def stg_maintenance(raw: DataFrame) -> DataFrame:
    return stage(raw, "maintenance_logs")


def stg_gps_events(raw: DataFrame, box=None) -> DataFrame:
    """Pings inside the service area; the filter reaches the file scan."""
    return stage(raw.where(inside_box() if box is None else box), "gps_events")


def views() -> dict[str, tuple]:
    """The staged tables as rows of the raw ones: staging casts to the types raw already has and filters."""
    whole = {t: (f"raw.{r}", F.lit(True)) for t, r in (
        ("silver.stg_routes", "routes"), ("silver.stg_vehicles", "vehicles"), ("silver.stg_maintenance", "maintenance_logs"))}
    return whole | {"silver.stg_gps_events": ("raw.gps_events", inside_box())}
