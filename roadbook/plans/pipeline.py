"""The daily run: landed files to marts, one event date at a time.

Trips never cross a day, so a late ping only touches its own date, its month
and nothing else. A run recomputes exactly the dates its batch has pings for;
running it again gives the same tables.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.checks import ledger, quality
from roadbook.checks.ledger import among
from roadbook.operators import staging
from roadbook.operators.latest import latest_by
from roadbook.plans import gold, silver
from roadbook.schemas import TABLES
from roadbook.sources.files import changed_batches
from roadbook.sources.landing import require_landed
from roadbook.sources.loader import BATCH, LoadResult, load_all, load_table, raw_table
from roadbook.sources.warehouse import Run, Warehouse

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    loads: list[LoadResult]
    dates: list[date | None] | None
    checks: list


# Facts are never collapsed: two batches may reuse an id for different pings.
DIMENSIONS = ("routes", "vehicles")


def raw_tables(warehouse: Warehouse, latest_dimensions: bool = False) -> dict[str, DataFrame]:
    """The accepted raw rows. Loads append, so a second landed day repeats the
    dimension rows; ``latest_dimensions`` keeps the newest load of each key."""
    raw = {t: raw_table(warehouse, t) for t in TABLES}
    if latest_dimensions:
        raw |= {t: latest_by(raw[t], TABLES[t].key, [BATCH, "_loaded_at"]) for t in DIMENSIONS}
    return raw


def staged(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_routes": staging.stg_routes(raw["routes"]),
        "stg_vehicles": staging.stg_vehicles(raw["vehicles"]),
        "stg_gps_events": staging.stg_gps_events(raw["gps_events"]),
        "stg_maintenance": staging.stg_maintenance(raw["maintenance_logs"]),
    }


Days = list[date | None]  # None stands for pings without a date

# A version's notes: days whose silver and gold rows may differ from raw, kept until a run has published them;
# and tables that were published without a gate.
PENDING, UNCHECKED = "pending", "unchecked"


def _days(pings: DataFrame) -> Days:
    """The event dates of pings: each is a folder of the stored tables, which the driver lists anyway."""
    return [r.event_date for r in pings.select("event_date").distinct().collect()]


def days_of_batch(warehouse: Warehouse, batch_date: str) -> Days:
    if not warehouse.exists("raw.gps_events"):
        return []
    return _days(raw_table(warehouse, "gps_events").where(F.col(BATCH) == F.lit(batch_date).cast("date")))


def pending_days(warehouse: Warehouse) -> Days:
    return [d and date.fromisoformat(d) for d in warehouse.version().notes.get(PENDING, [])]


def _remember(warehouse: Warehouse, days: Days) -> Days:
    """Add days to the pending ones, before anything changes that they depend on."""
    texts = [d and str(d) for d in days]
    if not set(texts) <= set(warehouse.version().notes.get(PENDING, [])):
        warehouse.publish(warehouse.begin(), {}, notes=lambda now: {**now, PENDING: list(dict.fromkeys([*now.get(PENDING, []), *texts]))})
    return pending_days(warehouse)


# silver and gold tables, each with the column that it is stored by and rebuilt by
PARTS = {
    "silver.int_route_segments": "event_date",
    "silver.int_vehicle_daily_stats": "event_date",
    "gold.mart_route_efficiency": "segment_date",
    "gold.mart_driver_performance": "month",
    "gold.mart_fleet_health": None,
}


def _months(days: Days) -> Days:
    return list(dict.fromkeys(d and d.replace(day=1) for d in days))


SEGMENTS = "silver.int_route_segments"


def _merged(warehouse: Warehouse, made: DataFrame, name: str, values: Days | None) -> DataFrame:
    """A table as it will be once ``made`` is published."""
    column = PARTS[name]
    if values is None or column is None or not warehouse.exists(name):
        return made
    return warehouse.read(name).where(~among(F.col(column), values)).unionByName(made)


@dataclass(frozen=True)
class Build:
    """What a run has made: each table's own rows, as it will be published, and what its row checks counted."""

    written: dict[str, DataFrame]
    merged: dict[str, DataFrame]
    checks: list


def replaced_values(days: Days | None) -> dict[str, Days | None]:
    """For each table the values that a run of these days replaces."""
    months = None if days is None else _months(days)
    return {n: None if c is None else months if c == "month" else days for n, c in PARTS.items()}


def build(warehouse: Warehouse, run: Run, as_of: date, days: Days | None = None,
          latest_dimensions: bool = False) -> Build:
    """Silver and gold for the given days, or for all, written by a run; row checks are counted on the way."""
    stg = staged(raw_tables(warehouse, latest_dimensions))
    gps = stg["stg_gps_events"]
    values = replaced_values(days)
    made = Build({}, {}, [])

    def put(name: str, df: DataFrame) -> DataFrame:
        parts = quality.parts_of(name)
        written, counted = run.write_counted(df, name, ledger.counts_of(parts), *filter(None, [PARTS[name]]))
        made.checks.extend(ledger.results_of(parts, counted))
        made.written[name] = written
        made.merged[name] = _merged(warehouse, written, name, values[name])
        return written

    # written once, read by both roll-ups
    segments = put(SEGMENTS, silver.int_route_segments(
        gps if days is None else gps.where(among(F.col("event_date"), days)), stg["stg_routes"]))
    put("gold.mart_route_efficiency", gold.mart_route_efficiency(segments))
    put("silver.int_vehicle_daily_stats", silver.int_vehicle_daily_stats(segments))
    daily = made.merged["silver.int_vehicle_daily_stats"]
    if days is not None:
        daily = daily.where(among(F.trunc("event_date", "MM"), _months(days)))
    put("gold.mart_driver_performance", gold.mart_driver_performance(daily, stg["stg_vehicles"]))
    put("gold.mart_fleet_health", gold.mart_fleet_health(stg["stg_vehicles"], stg["stg_maintenance"], as_of))
    return made


MARTS = ("mart_route_efficiency", "mart_fleet_health", "mart_driver_performance")


def marts(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The marts of one version: they belong together, also while a run publishes."""
    now = warehouse.at()
    return {name: now.read(f"gold.{name}") for name in MARTS}


def check_inputs(warehouse: Warehouse, latest_dimensions: bool = False) -> list:
    """Gate on the raw tables and the staged views of them.

    What a load has counted is taken from the ledger. Only tables that it does not know, and dimensions of
    which just the newest rows count, are read.
    """
    now = warehouse.at()
    collapsed = {f"raw.{t}" for t in DIMENSIONS} if latest_dimensions else set()
    views = staging.views()
    known = {s: quality.parts_of(s, views=views) for s in sorted(ledger.known_sources(now)) if s.startswith("raw.") and s not in collapsed}
    rows = ledger.report(now, known) if known else []
    others = {f"raw.{t}": df for t, df in raw_tables(now, latest_dimensions).items()
              if f"raw.{t}" not in known and f"raw.{t}" in quality.CHECKS}
    if others:
        rows += quality.report(others, views=views).collect()
    return quality.gate(rows)


def _unique(warehouse: Warehouse, run: Run, made: Build, days: Days | None) -> tuple[list, dict]:
    """Uniqueness of what will be published: of segments by the days' keys, of the fleet by its one table."""
    parts = quality.parts_of(SEGMENTS)
    found, tables = ledger.repeats(warehouse, run, SEGMENTS, parts, made.written[SEGMENTS], "event_date", days)
    for name in PARTS:
        if name != SEGMENTS and quality.CHECKS[name].unique:  # a whole table, which the run has just written
            for counted in quality.unique_checks(made.merged[name], quality.parts_of(name)):
                found += [ledger.result(*r) for r in counted.collect()]
    return found, tables


def rebuild(warehouse: Warehouse, as_of: date, days: Days | None = None, latest_dimensions: bool = False,
            check: bool = True) -> list:
    """Make silver and gold, check them, and only then publish them, all in one step.

    The checks read what the run wrote, and of the rest of a table only keys that the run touched; the rest
    was checked when it was published. Tables that were published without a check are read whole.
    """
    base = warehouse.at()
    if not base.exists(SEGMENTS):
        days = None
    run = base.begin()
    try:
        made = build(base, run, as_of, days, latest_dimensions)
        unique, keys = _unique(base, run, made, days)
        checks = []
        if check:
            late = {n: made.merged[n] for n in base.version().notes.get(UNCHECKED, []) if made.merged[n] is not made.written[n]}
            again = quality.report(late, quality.ROW_KINDS).collect() if late else []
            checks = quality.gate([c for c in made.checks if c.table_name not in late] + again + unique)
        done = set(base.version().notes.get(PENDING, [])) if days is None else {d and str(d) for d in days}
        note = ledger.noting(SEGMENTS, {}, [r for r in unique if r.table_name == SEGMENTS], days)
        warehouse.publish(run, {**replaced_values(days), **keys}, base.version(), [*PARTS, *keys], lambda now: {
            **note(now), PENDING: [d for d in now.get(PENDING, []) if d not in done], UNCHECKED: [] if check else list(PARTS)})
    finally:
        run.remove()
    return checks


def run(spark: SparkSession, landing: str, root: str, batch_date: str, as_of: date,
        tables: Iterable[str] | None = None, full_refresh: bool = False,
        latest_dimensions: bool = False) -> RunResult:
    """Check that the batch has landed, load it, check it, rebuild what it touches, check that, publish.

    Raw always holds the batch as it landed. Silver and gold change only when all
    checks have passed, on whole tables; a run that fails leaves them as they were
    and its days to the next run. Pass ``full_refresh`` when attributes of routes
    or vehicles changed: stored days and months keep those they were built with.
    """
    warehouse = Warehouse(spark, root)
    known = [t for t in tables or TABLES if t in TABLES]
    require_landed(spark, landing, batch_date, known)
    _remember(warehouse, days_of_batch(warehouse, batch_date))
    loads = load_all(spark, landing, warehouse, tables, batch_date)
    days = _remember(warehouse, days_of_batch(warehouse, batch_date))
    checks = check_inputs(warehouse, latest_dimensions)

    checks += rebuild(warehouse, as_of, None if full_refresh else days, latest_dimensions)
    wanted = None if full_refresh else days
    log.info("batch %s: %d checks passed", batch_date, len(checks))
    return RunResult(loads, wanted, checks)


def run_new_files(spark: SparkSession, landing: str, root: str, as_of: date,
                  tables: Iterable[str] | None = None, latest_dimensions: bool = False) -> RunResult:
    """As :func:`run`, for every batch with files that are new, rewritten or gone since it was loaded.

    Such a batch loads again as a whole, from the files that it has now.
    """
    warehouse = Warehouse(spark, root)
    loads: list[LoadResult] = []
    for table in [t for t in tables or TABLES if t in TABLES]:
        for batch in map(str, changed_batches(spark, landing, warehouse, table)):
            pings = table == "gps_events"
            _remember(warehouse, days_of_batch(warehouse, batch) if pings else [])
            loads.append(load_table(spark, landing, warehouse, table, batch))
            _remember(warehouse, days_of_batch(warehouse, batch) if pings else [])
    days = pending_days(warehouse)
    checks = check_inputs(warehouse, latest_dimensions)
    checks += rebuild(warehouse, as_of, days, latest_dimensions)
    return RunResult(loads, days, checks)
