"""Run the declared checks as aggregations.

All row checks of a table, and of the staged view of it, are counted in one pass
over it; each unique column adds one grouping for both, aggregated before its
shuffle, so copies of one key collapse on the map side. Every result row is
``(table_name, check_name, column_name, failing_rows, passed)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.checks.registry import CHECKS, Checks

ROW_KINDS = ("not_null", "accepted_values", "range", "positive")
ALL_KINDS = (*ROW_KINDS, "unique")


def _fails_row_checks(checks: Checks, kinds: Iterable[str]) -> list[tuple[str, str, Column]]:
    """(check, column, condition that marks a failing row); NULL only fails not_null."""
    found: list[tuple[str, str, Column]] = []
    if "not_null" in kinds:
        found += [("not_null", c, F.col(c).isNull()) for c in checks.not_null]
    if "accepted_values" in kinds:
        found += [("accepted_values", c, ~F.col(c).isin(values))
                  for c, values in checks.accepted.items()]
    if "range" in kinds:
        found += [("range", c, ~F.col(c).between(*bounds)) for c, bounds in checks.ranges.items()]
    if "positive" in kinds:
        found += [("positive", c, F.col(c) <= 0) for c in checks.positive]
    return found


Part = tuple[str, Checks, Column]  # a table's name and checks, and which rows of the frame are its own


def row_conditions(parts: list[Part], kinds: Iterable[str] = ROW_KINDS) -> list[tuple[str, str, str, Column]]:
    """Each row check of a frame, and of tables that are some of its rows: table, check, column, which rows fail."""
    return [(table, check, column, own & fails) for table, checks, own in parts
            for check, column, fails in _fails_row_checks(checks, kinds)]


def row_checks(df: DataFrame, parts: list[Part], kinds: Iterable[str] = ROW_KINDS) -> DataFrame | None:
    """All row checks of a frame, and of tables that are some of its rows, in one pass."""
    conditions = row_conditions(parts, kinds)
    if not conditions:
        return None
    return df.agg(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                 F.lit(column).alias("column_name"), F.count_if(fails).alias("failing_rows"))
        for table, check, column, fails in conditions
    ]).alias("results")).select(F.inline("results"))


def unique_checks(df: DataFrame, parts: list[Part]) -> list[DataFrame]:
    """Counts the values that occur more than once; NULLs are ignored. One grouping a column."""
    found = []
    for column in dict.fromkeys(c for _, checks, _ in parts for c in checks.unique):
        tables = [(f"n{i}", table, own) for i, (table, checks, own) in enumerate(parts) if column in checks.unique]
        per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(
            *[F.count_if(own).alias(n) for n, _, own in tables])
        found.append(per_value.agg(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"),
                     F.lit(column).alias("column_name"), F.count_if(F.col(n) > 1).alias("failing_rows"))
            for n, table, _ in tables]).alias("results")).select(F.inline("results")))
    return found


def parts_of(table: str, registry: Mapping[str, Checks] = CHECKS, views: Mapping[str, tuple[str, Column]] | None = None) -> list[Part]:
    """A table's checks, and those of its views, each over its own rows."""
    parts = [(table, registry.get(table, Checks()), F.lit(True))]
    return parts + [(view, registry.get(view, Checks()), F.coalesce(own, F.lit(False)))
                    for view, (of, own) in (views or {}).items() if of == table]


def report(tables: Mapping[str, DataFrame], kinds: Iterable[str] = ALL_KINDS,
           registry: Mapping[str, Checks] = CHECKS,
           views: Mapping[str, tuple[str, Column]] | None = None) -> DataFrame:
    """``views`` names tables that are some rows of another one: they are checked in its passes."""
    kinds = set(kinds)
    results = []
    for table, df in tables.items():
        parts = parts_of(table, registry, views)
        rows = row_checks(df, parts, kinds)
        if rows is not None:
            results.append(rows)
        if "unique" in kinds:
            results += unique_checks(df, parts)
    if not results:
        raise ValueError(f"no checks of kind {sorted(kinds)} for {list(tables)}")
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failing_rows") == 0)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(table).alias("table_name"), "row_count")
              for table, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def missing_columns(df: DataFrame, required: Iterable[str]) -> set[str]:
    return set(required) - set(df.columns)


class QualityGateFailed(RuntimeError):
    pass


def gate(results: DataFrame | list) -> list:
    """Raise if any check failed; the report has one short row a declared check."""
    rows = results if isinstance(results, list) else results.collect()
    failed = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failing_rows}"
              for r in rows if not r.passed]
    if failed:
        raise QualityGateFailed("; ".join(sorted(failed)))
    return rows
