"""Declared schemas of the five landed tables, in file order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    max_length: int | None = None


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    columns: tuple[Column, ...]
    partition: str | None = None  # clustering column of the stored table
    multiline: bool = False       # free text may hold quoted newlines

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def typed_schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.type}" for c in self.columns))

    def string_schema(self, *extra: str) -> T.StructType:
        names = [*self.names, *extra]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _text(name: str, max_length: int) -> Column:
    return Column(name, "string", max_length)


TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table("routes", "route_id", (
            _text("route_id", 20),
            _text("route_name", 100),
            _text("zone", 50),
            _text("district", 50),
            Column("total_stops", "int"),
            Column("created_at", "timestamp_ntz"),
        )),
        Table("vehicles", "vehicle_id", (
            _text("vehicle_id", 20),
            _text("make", 50),
            _text("model", 50),
            Column("year", "int"),
            _text("vehicle_class", 20),
            _text("status", 20),
            _text("vin", 20),
            _text("license_plate", 20),
        )),
        Table("stops", "stop_id", (
            _text("stop_id", 20),
            _text("route_id", 20),
            _text("stop_name", 200),
            Column("stop_sequence", "int"),
            Column("lat", "double"),
            Column("lon", "double"),
            _text("stop_type", 20),
        )),
        Table("gps_events", "event_id", (
            _text("event_id", 20),
            _text("vehicle_id", 20),
            _text("route_id", 20),
            Column("lat", "double"),
            Column("lon", "double"),
            Column("speed_mph", "double"),
            Column("heading_deg", "int"),
            Column("event_ts", "timestamp_ntz"),
            Column("event_date", "date"),
        ), partition="event_date"),
        Table("maintenance_logs", "log_id", (
            _text("log_id", 20),
            _text("vehicle_id", 20),
            _text("service_type", 100),
            Column("service_date", "date"),
            Column("cost_usd", "double"),
            Column("mileage_at_service", "int"),
            _text("technician", 100),
            _text("notes", 500),
        ), multiline=True),
    )
}
