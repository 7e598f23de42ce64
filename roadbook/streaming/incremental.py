"""Load each landed file exactly once, whenever it arrives.

The file source remembers in its checkpoint which files it has taken, and the
file sink commits a batch as a whole: a second run adds nothing, a new file
adds its rows, and a lost driver neither repeats nor skips a file. Landed files
must not be rewritten in place; a rewritten file is not read again.

Give this loader a raw folder of its own. The batch loader replaces partitions,
which a streaming sink's commit log does not follow.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from roadbook.schemas import TABLES
from roadbook.sources.landing import CORRUPT, csv_options, landing_folder
from roadbook.sources.loader import STATUS, LoadResult, partition_columns, storable, stored_schema
from roadbook.sources.warehouse import Warehouse


def load_new_files(spark: SparkSession, landing: str, warehouse: Warehouse, table: str,
                   checkpoint: str) -> LoadResult:
    """Load the files that landed since the last call, then stop."""
    before = _stored_counts(spark, warehouse, table)
    schema = TABLES[table].string_schema(CORRUPT).add("date", "date")
    landed = (spark.readStream.schema(schema).options(**csv_options(table))
              .csv(landing_folder(landing, table)))
    query = (
        storable(landed, table)
        .writeStream.format("parquet")
        .option("path", warehouse.path(f"raw.{table}"))
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table}")
        .partitionBy(*partition_columns(table))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # the sink's own record of what it stored, not the progress reports, of which Spark keeps the last few
    after = _stored_counts(spark, warehouse, table)
    return LoadResult(table, *(a - b for a, b in zip(after, before)))


def _stored_counts(spark: SparkSession, warehouse: Warehouse, table: str) -> tuple[int, int]:
    """Loaded and rejected rows so far: partition values only, no column is read."""
    if not warehouse.exists(f"raw.{table}"):
        return 0, 0
    stored = spark.read.schema(stored_schema(table)).parquet(warehouse.path(f"raw.{table}"))
    counts = {r[STATUS]: r["count"] for r in stored.groupBy(STATUS).count().collect()}
    return counts.get("loaded", 0), counts.get("rejected", 0)
