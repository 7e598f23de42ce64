"""Load landed partitions into the raw layer."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbook.checks import ledger
from roadbook.checks.quality import parts_of
from roadbook.operators.rejects import REASON, parse
from roadbook.operators.staging import views
from roadbook.schemas import TABLES
from roadbook.sources.files import note_files
from roadbook.sources.landing import has_files, landed_dates, landing_folder, read_landed, require_landed
from roadbook.sources.warehouse import Warehouse

log = logging.getLogger(__name__)

STATUS = "load_status"
BATCH = "batch_date"


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows_loaded: int
    rows_errored: int

    @property
    def status(self) -> str:
        return "success" if self.rows_errored == 0 else "partial"


def storable(landed: DataFrame, table: str) -> DataFrame:
    """Parsed rows with load time, batch date and status; good and bad in one frame."""
    return (
        parse(landed, table)
        .withColumnRenamed("date", BATCH)
        .withColumn("_loaded_at", F.current_timestamp().cast("timestamp_ntz"))
        .withColumn(STATUS, F.when(F.col(REASON).isNull(), "loaded").otherwise("rejected"))
        .select(*stored_schema(table).names)
    )


def partition_columns(table: str) -> list[str]:
    clustered = TABLES[table].partition
    return [BATCH, STATUS] + ([clustered] if clustered else [])


def stored_schema(table: str) -> T.StructType:
    """Declared, so that an empty or a huge raw table reads without inference."""
    schema = TABLES[table].typed_schema()
    for name, kind in ((REASON, "string"), ("_raw", "string"), ("_loaded_at", "timestamp_ntz"),
                       (BATCH, "date"), (STATUS, "string")):
        schema = schema.add(name, kind)
    return schema


def load_table(spark: SparkSession, landing: str, warehouse: Warehouse, table: str,
               batch_date: str | None = None) -> LoadResult:
    """Load one landed date, or every landed date, in a single pass over the files.

    Each loaded date replaces the whole of what the same date loaded before; dates
    that are no longer landed keep what they have. Running it twice changes
    nothing, and a run that died half way is simply run again. Rows, rejects and the
    failing rows of every check are counted while a date is written; the rows, what
    failed, their keys and their files are published as one version. A file without a
    needed column is refused by name before anything is loaded.
    """
    base = warehouse.at()
    run, name = base.begin(), f"raw.{table}"
    batches = [date.fromisoformat(b) for b in ([batch_date] if batch_date else landed_dates(spark, landing, table))]
    parts = parts_of(name, views=views())
    loaded = F.col(STATUS) == "loaded"
    rows = {"loaded": F.count_if(loaded), "rejected": F.count_if(~loaded)}
    failing = ledger.counts_of(parts, loaded)
    try:
        files = note_files(spark, landing, run, table, batches)
        if batch_date is None or has_files(spark, landing_folder(landing, table, batch_date) + "/*.csv*"):
            landed = storable(read_landed(spark, landing, table, batch_date), table)
        else:  # its files are gone, and so are its rows
            landed = spark.createDataFrame([], stored_schema(table))
        stored, seen = run.write_counted(landed, name, rows | (failing if len(batches) == 1 else {}), *partition_columns(table))
        accepted = stored.where(loaded)
        if len(batches) == 1:
            by_unit = {str(batches[0]): ledger.results_of(parts, seen)}
        else:  # counts taken while writing tell no batch from another: one more scan, of many dates at once only
            counted = accepted.groupBy(BATCH).agg(*[c.alias(n) for n, c in failing.items()]).collect() if failing else []
            by_unit = {ledger.unit_text(r[BATCH]): ledger.results_of(parts, r.asDict()) for r in counted}
        repeated, keys = ledger.repeats(base, run, name, parts, accepted, BATCH, batches)
        warehouse.publish(run, {name: batches, **files, **keys}, base.version(), [name, *keys],
                          ledger.noting(name, by_unit, repeated, batches))
    finally:
        run.remove()
    return LoadResult(table, seen["loaded"], seen["rejected"])


def load_all(spark: SparkSession, landing: str, warehouse: Warehouse,
             tables: Iterable[str] | None = None,
             batch_date: str | None = None) -> list[LoadResult]:
    """Load the wanted tables side by side; names that are unknown or have not landed are told before any is loaded."""
    wanted = list(TABLES if tables is None else tables)
    known = [t for t in wanted if t in TABLES]
    if strange := sorted(set(wanted) - set(known)):
        log.warning("left out, not among the declared tables: %s", ", ".join(strange))
    require_landed(spark, landing, batch_date, known)
    load = inheritable_thread_target(spark)(lambda t: load_table(spark, landing, warehouse, t, batch_date))
    with ThreadPoolExecutor(max(1, len(known))) as side_by_side:
        return list(side_by_side.map(load, known))


def _stored(warehouse: Warehouse, table: str, status: str) -> DataFrame:
    name = f"raw.{table}"
    if name in warehouse.version().tables:
        stored = warehouse.read(name)
    else:  # a streaming loader's folder
        stored = warehouse.spark.read.schema(stored_schema(table)).parquet(warehouse.path(name))
    return stored.where(F.col(STATUS) == status)


def raw_table(warehouse: Warehouse, table: str) -> DataFrame:
    """The accepted rows of a raw table."""
    return _stored(warehouse, table, "loaded").drop(STATUS, REASON, "_raw")


def rejected_rows(warehouse: Warehouse, table: str) -> DataFrame:
    """The quarantined rows of a raw table, with their text and reason."""
    return _stored(warehouse, table, "rejected").select(BATCH, REASON, "_raw", "_loaded_at")
