"""Which landed files a raw table was loaded from, and which have changed since.

A load notes its files: path, length, time of change, number of lines, a digest of
them, and the header. Listing files reads none of them. A file whose length or time
differs from the note is read again, by splits, and counts as changed if its lines
do; so a file that was rewritten in place reloads its batch, one that was only
touched or copied back does not. A batch also changes with a file that is new or
gone.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.checks.registry import REQUIRED_COLUMNS
from roadbook.sources.landing import has_files, landing_folder
from roadbook.sources.warehouse import Run, Warehouse

FILES = "*.csv*"
SCHEMA = "path string, length long, modified timestamp, lines long, digest decimal(38,0), header string"


class MissingColumns(ValueError):
    """A landed file lacks a column that its table needs."""


def files_table(table: str) -> str:
    return f"state.files_{table}"


def _reader(spark: SparkSession, root: str, table: str, batches: Iterable[date] | None, form: str) -> DataFrame | None:
    """The landed files of some batches, or of all, by a file source; None if there is none."""
    base = landing_folder(root, table)
    folders = [base] if batches is None else [landing_folder(root, table, str(b)) for b in batches]
    folders = [f for f in folders if has_files(spark, f"{f}/{'*/' if batches is None else ''}{FILES}")]
    if not folders:
        return None
    reader = spark.read.format(form).option("basePath", base).option("pathGlobFilter", FILES).option("lineSep", "\n")
    return reader.load(folders)


def listing(spark: SparkSession, root: str, table: str, batches: Iterable[date] | None = None) -> DataFrame:
    """``path, length, modified, batch_date`` of the landed files; no file is opened."""
    files = _reader(spark, root, table, batches, "binaryFile")
    if files is None:
        return spark.createDataFrame([], "path string, length long, modified timestamp, batch_date date")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"),
                        F.col("_metadata.file_modification_time").alias("modified"), F.col("date").cast("date").alias("batch_date"))


def contents(spark: SparkSession, root: str, table: str, batches: Iterable[date] | None = None) -> DataFrame:
    """``path, lines, digest, header``: the lines of each file, whatever their order after the header; read by splits."""
    lines = _reader(spark, root, table, batches, "text")
    if lines is None:
        return spark.createDataFrame([], "path string, lines long, digest decimal(38,0), header string")
    first = F.when(F.col("_metadata.file_block_start") == 0, F.col("value"))
    return lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("decimal(38,0)").alias("digest"),
        F.first(first, ignorenulls=True).alias("header"))


def note_files(spark: SparkSession, root: str, run: Run, table: str, batches: list[date]) -> dict:
    """Write what the batches are loaded from, refuse files without a needed column; the table to publish."""
    noted = listing(spark, root, table, batches).join(contents(spark, root, table, batches), "path", "left")
    stored = run.write(noted.select("path", "length", "modified", "lines", "digest", "header", "batch_date"), files_table(table), "batch_date")
    names = F.transform(F.split(F.rtrim(F.regexp_replace("header", "\r", "")), ","), lambda n: F.trim(F.replace(n, F.lit('"'), F.lit(""))))
    required = F.array(*[F.lit(c) for c in REQUIRED_COLUMNS.get(f"raw.{table}", [])]).cast("array<string>")
    lacking = stored.select("path", F.array_except(required, names).alias("missing")).where("size(missing) > 0")
    if found := lacking.orderBy("path").limit(20).collect():
        raise MissingColumns("; ".join(f"{r.path} has no {', '.join(r.missing)}" for r in found))
    return {files_table(table): batches}


def changed_batches(spark: SparkSession, root: str, warehouse: Warehouse, table: str) -> list[date]:
    """The batches that have files which are new, rewritten or gone since they were loaded."""
    now = listing(spark, root, table)
    name = files_table(table)
    if not warehouse.exists(name):
        return [r[0] for r in now.select("batch_date").distinct().orderBy("batch_date").collect()]
    noted = warehouse.read(name).select(*[F.col(c).alias(f"was_{c}") for c in ("path", "length", "modified", "lines", "digest", "batch_date")])
    met = now.join(noted, F.col("path") == F.col("was_path"), "full_outer")
    come_or_gone = met.where("path is null or was_path is null").select(F.coalesce("batch_date", "was_batch_date").alias("batch_date"))
    suspect = met.where("length <> was_length or modified <> was_modified").select("path", "was_lines", "was_digest", "batch_date")
    batches = {r[0] for r in come_or_gone.distinct().collect()}
    again = [r[0] for r in suspect.select("batch_date").distinct().collect() if r[0] not in batches]
    if again:
        read = suspect.join(contents(spark, root, table, again), "path", "left")
        differs = ~(F.col("lines").eqNullSafe(F.col("was_lines")) & F.col("digest").eqNullSafe(F.col("was_digest")))
        batches |= {r[0] for r in read.where(differs & F.col("batch_date").isin(again)).select("batch_date").distinct().collect()}
    return sorted(batches)
