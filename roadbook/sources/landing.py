"""Landed CSV partitions: where they are, whether they are all there, how to read them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.schemas import TABLES
from roadbook.sources import multiline

CORRUPT = "_bad"


# Fixed format: where the producers put their files.
def landing_key(table: str, batch_date: str, filename: str) -> str:
    return f"raw/{table}/date={batch_date}/{filename}"


def landing_folder(root: str, table: str, batch_date: str | None = None) -> str:
    folder = f"{root.rstrip('/')}/raw/{table}"
    return f"{folder}/date={batch_date}" if batch_date else folder


def csv_options(table: str) -> dict[str, str]:
    """Header skipped, columns by position, bad lines kept in ``_bad``.

    Column pruning is off because it would let a short or long line pass when
    a query happens not to need all columns.
    """
    return {
        "header": "true",
        "enforceSchema": "true",
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "columnPruning": "false",
        "multiLine": str(TABLES[table].multiline).lower(),
    }


def has_files(spark: SparkSession, pattern: str) -> bool:
    """Whether any file matches; the path is only listed, nothing is read."""
    try:
        spark.read.text(pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def missing_tables(spark: SparkSession, root: str, batch_date: str | None,
                   tables: Iterable[str] = tuple(TABLES)) -> list[str]:
    """Tables without a landed file, of one date or of any."""
    day = batch_date or "*"
    return [t for t in tables if not has_files(spark, landing_folder(root, t, day) + "/*.csv*")]


def require_landed(spark: SparkSession, root: str, batch_date: str | None,
                   tables: Iterable[str] = tuple(TABLES)) -> None:
    missing = missing_tables(spark, root, batch_date, tables)
    if missing:
        raise FileNotFoundError(f"no landed files for {missing} on {batch_date or 'any date'} under {root}")


def read_landed(spark: SparkSession, root: str, table: str,
                batch_date: str | None = None) -> DataFrame:
    """All text columns plus ``_bad`` and ``date``; one partition, or the whole table.

    A table whose text may hold newlines is put together from lines, so that many tasks read one file.
    """
    folder, base = landing_folder(root, table, batch_date), landing_folder(root, table)
    if TABLES[table].multiline:
        rows = multiline.split_rows(multiline.read_lines_of(spark, folder, base, ("date",)), ("date",))
        return read_lines(multiline.without_header(rows).withColumnRenamed("row", "line"), table, "date")
    reader = spark.read.schema(TABLES[table].string_schema(CORRUPT)).options(**csv_options(table))
    return reader.option("basePath", base).csv(folder)


def read_lines(lines: DataFrame, table: str, *keep: str) -> DataFrame:
    """A column ``line`` of a table's file lines, read as the file would be; for text that comes by other ways."""
    options = {k: v for k, v in csv_options(table).items() if k not in ("header", "enforceSchema", "columnPruning")}
    if TABLES[table].multiline:
        options["lineSep"] = "\n"  # known, not to be found out from each row
    schema = TABLES[table].string_schema(CORRUPT)
    row = F.from_csv("line", schema.toDDL(), options)
    # inline makes the row a value, as in a file, not an expression each use repeats
    return lines.select(F.inline(F.array(row)), *keep)


def landed_dates(spark: SparkSession, root: str, table: str) -> list[str]:
    """The dates that have a landed file, also an empty one; files are listed, not read."""
    files = spark.read.format("binaryFile").load(landing_folder(root, table))
    return [str(r.date) for r in files.select("date").distinct().collect()] if "date" in files.columns else []
