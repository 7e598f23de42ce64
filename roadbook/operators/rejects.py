"""Turn landed text into typed rows, and name the reason when that fails.

A bad row never stops a load: it is kept aside with its text and one reason,
so loaded plus rejected always adds up to what was landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.schemas import TABLES, Table
from roadbook.settings import LARGEST_DOUBLE
from roadbook.sources.landing import CORRUPT

# The spellings of a missing value in a landed file.
NULL_TOKENS = ["", "NULL", "null"]

REASON = "_reason"


def _text(name: str) -> str:
    return f"_text_{name}"


def _reason(spec: Table, has_corrupt: bool) -> Column:
    """The first thing wrong with the row, or NULL."""
    found = []
    if has_corrupt:
        found.append(F.when(F.col(CORRUPT).isNotNull(), "malformed line"))
    found.append(F.when(F.col(spec.key).isNull(), f"missing {spec.key}"))
    for c in spec.columns:
        if c.max_length is not None:
            found.append(F.when(F.length(c.name) > c.max_length, f"too long {c.name}"))
        else:
            # NaN sorts above infinity, so one comparison rejects both
            valid = F.abs(c.name) < float("inf") if c.type == "double" else F.col(c.name).isNotNull()
            bad = F.col(_text(c.name)).isNotNull() & ~F.coalesce(valid, F.lit(False))
            found.append(F.when(bad, f"bad {c.name}"))
            if c.type == "double":  # a value that could not be summed exactly must not stop every later run
                found.append(F.when(F.abs(c.name) > LARGEST_DOUBLE, f"out of bounds {c.name}"))
    return F.coalesce(*found)


def parse(raw: DataFrame, table: str) -> DataFrame:
    """Typed columns, ``_reason``, and ``_raw`` (the original text) on bad rows.

    Other columns of ``raw``, such as the partition date, pass through. Each
    step builds on the columns of the one before; where a filter on the reason
    is pushed down, Spark works out a text's cast for the filter once more.
    """
    spec = TABLES[table]
    names = [c for c in raw.columns if c in spec.names or c == CORRUPT]
    rest = [c for c in raw.columns if c not in names]
    original = F.struct(*names).alias("_original")
    cleaned = raw.select(
        *[F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)).alias(_text(c)) for c in spec.names],
        *[c for c in names if c == CORRUPT], *rest, original)
    typed = cleaned.select(
        "*", *[F.col(_text(c.name)).try_cast(c.type).alias(c.name) for c in spec.columns])
    judged = typed.withColumn(REASON, _reason(spec, CORRUPT in names))
    bad_text = F.when(F.col(REASON).isNotNull(), F.to_json("_original"))
    return judged.select(*spec.names, *rest, REASON, bad_text.alias("_raw"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNull()).drop(REASON, "_raw")


def rejected(parsed: DataFrame, table: str) -> DataFrame:
    rest = [c for c in parsed.columns if c not in TABLES[table].names]
    return parsed.where(F.col(REASON).isNotNull()).select(*rest)


def load_counts() -> list[Column]:
    """Aggregates over parsed rows: how many loaded, how many errored."""
    return [
        F.count_if(F.col(REASON).isNull()).alias("rows_loaded"),
        F.count_if(F.col(REASON).isNotNull()).alias("rows_errored"),
    ]


def load_summary(parsed: DataFrame, table: str) -> DataFrame:
    return parsed.agg(*load_counts()).select(
        F.lit(table).alias("table_name"),
        "rows_loaded",
        "rows_errored",
        F.when(F.col("rows_errored") == 0, "success").otherwise("partial").alias("status"),
    )
