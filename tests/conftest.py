from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roadbook.schemas import TABLES  # noqa: E402
from roadbook.session import build_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions=4,
                            spark__driver__memory="4g",
                            spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame of a declared table from dicts; columns left out are NULL."""
    def build(table: str, rows: list[dict]):
        schema = TABLES[table].typed_schema()
        return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
    return build


def ping(event_id: str, ts: str | None, vehicle: str | None = "VH-1", route: str | None = "RT-1",
         lat: float | None = 29.7, lon: float | None = -95.4, speed: float | None = 30.0,
         day: date | None = date(2024, 1, 15)) -> dict:
    return {"event_id": event_id, "vehicle_id": vehicle, "route_id": route, "lat": lat, "lon": lon,
            "speed_mph": speed, "heading_deg": 90,
            "event_ts": datetime.fromisoformat(ts) if ts else None, "event_date": day}
