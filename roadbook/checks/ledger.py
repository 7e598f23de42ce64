"""What has been checked, kept beside the tables, so that a daily gate reads its batch only.

Row checks are counted while rows are written, and what failed is noted in the
version that holds the rows; uniqueness is told from stored keys (``keys``). Both are
kept by unit: the batch of a raw table, the day of a silver one. A unit that is
written again replaces its notes and keys in the version that replaces its rows, so
what the ledger says is what a report over the whole tables would. Notes name failing
checks only, so they are few wherever the gate is heeded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from roadbook.checks import keys
from roadbook.checks.quality import Part, row_conditions
from roadbook.sources.warehouse import NULL_PARTITION, Run, Warehouse

FAILING = "failing"  # the note: source, unit, then table, check, column and failing rows
WHOLE = "whole"  # the unit of what is known of a table as a whole: its repeated values

Unit = object  # a value of the unit column


def unit_text(unit: Unit) -> str:
    return NULL_PARTITION if unit is None else str(unit)


def result(table: str, check: str, column: str, failing: int) -> Row:
    return Row(table_name=table, check_name=check, column_name=column, failing_rows=failing, passed=failing == 0)


def counts_of(parts: list[Part], own: Column | None = None) -> dict[str, Column]:
    """Aggregates, by name: the failing rows of every row check of a table and its views."""
    own = F.lit(True) if own is None else own
    return {f"c{i}": F.count_if(own & fails) for i, (*_, fails) in enumerate(row_conditions(parts))}


def results_of(parts: list[Part], counted: Mapping[str, int]) -> list[Row]:
    return [result(table, check, column, counted[f"c{i}"]) for i, (table, check, column, _) in enumerate(row_conditions(parts))]


def unique_columns(parts: list[Part]) -> dict[str, list[tuple[str, Column]]]:
    """Each column that must be unique, with the tables and views that say so."""
    columns = dict.fromkeys(c for _, checks, _ in parts for c in checks.unique)
    return {c: [(table, own) for table, checks, own in parts if c in checks.unique] for c in columns}


def keys_table(source: str, column: str) -> str:
    return f"state.keys_{source.split('.')[1]}_{column}"


def repeats(base: Warehouse, run: Run, source: str, parts: list[Part], made: DataFrame, unit: str,
            units: Iterable[Unit] | None) -> tuple[list[Row], dict]:
    """Uniqueness of a source once ``made`` has replaced the units, all if None; and the key tables to publish for it.

    ``base`` is the warehouse as the run found it.
    """
    found, tables = [], {}
    noted = base.version().notes.get(FAILING, {}).get(source, {}).get(WHOLE, []) if units is not None else []
    known = {(table, column): failing for table, _, column, failing in noted}
    for column, owners in unique_columns(parts).items():
        name = keys_table(source, column)
        new = run.write(keys.key_rows(made, column, unit, [own for _, own in owners]), name, unit, order=("bucket", "key"))
        tables[name] = units
        if units is not None and base.exists(name):
            stored, replaced = base.read(name), among(F.col(unit), units)
            old, rest = stored.where(replaced), stored.where(~replaced)
        else:
            old = rest = new.limit(0)
        touched = keys.touched_keys(old, new)
        added = keys.added_repeats(rest, old, new, touched, len(owners), keys.buckets_of(touched)).first()
        found += [result(table, "unique", column, known.get((table, column), 0) + (added[f"r{i}"] or 0))
                  for i, (table, _) in enumerate(owners)]
    return found, tables


def noting(source: str, by_unit: Mapping[str, list[Row]], whole: list[Row], units: Iterable[Unit] | None) -> Callable[[dict], dict]:
    """A change of a version's notes: what failed in the given units, all if None, takes the place of what was noted of them."""
    def change(notes: dict) -> dict:
        before = notes.get(FAILING, {}).get(source, {}) if units is not None else {}
        gone = {WHOLE, *[unit_text(u) for u in units or ()]}
        now = {u: rows for u, rows in before.items() if u not in gone}
        now |= {u: failed for u, rows in by_unit.items() if (failed := [list(r[:4]) for r in rows if r.failing_rows])}
        now[WHOLE] = [list(r[:4]) for r in whole if r.failing_rows]
        return {**notes, FAILING: {**notes.get(FAILING, {}), source: now}}

    return change


def report(warehouse: Warehouse, parts: Mapping[str, list[Part]]) -> list[Row]:
    """Every check of the sources and their views over whole tables, from the notes."""
    noted = warehouse.version().notes.get(FAILING, {})
    found: dict[tuple, int] = {}
    for source in parts:
        for rows in noted.get(source, {}).values():
            for *check, failing in rows:
                found[tuple(check)] = found.get(tuple(check), 0) + failing
    checks = [c[:3] for own in parts.values() for c in row_conditions(own)]
    checks += [(table, "unique", column) for own in parts.values() for column, owners in unique_columns(own).items() for table, _ in owners]
    return [result(*check, found.get(check, 0)) for check in checks]


def known_sources(warehouse: Warehouse) -> set[str]:
    """The sources that the ledger covers."""
    return set(warehouse.version().notes.get(FAILING, {}))


def among(value: Column, wanted: Iterable[Unit]) -> Column:
    """Whether a value is one of some, NULL counting as a value; literals, so that they prune a scan's partitions."""
    wanted = list(wanted)
    named = value.isin([w for w in wanted if w is not None])
    return F.coalesce(named | value.isNull() if None in wanted else named, F.lit(False))
