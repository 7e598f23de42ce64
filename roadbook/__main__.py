"""Command line: load landed files, or run the whole day.

    python -m roadbook load --landing L --warehouse W [--batch D] [--only routes stops]
    python -m roadbook run  --landing L --warehouse W --batch D [--as-of D]
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from roadbook.plans import pipeline
from roadbook.schemas import TABLES
from roadbook.session import build_session
from roadbook.sources.loader import LoadResult, load_all
from roadbook.sources.warehouse import Warehouse


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="roadbook", description=__doc__.splitlines()[0])
    what = top.add_subparsers(dest="command", required=True)
    for name, help_ in (("load", "landed files into the raw tables"), ("run", "load, check, rebuild, check, publish")):
        one = what.add_parser(name, help=help_)
        one.add_argument("--landing", required=True, metavar="FOLDER")
        one.add_argument("--warehouse", required=True, metavar="FOLDER")
        one.add_argument("--only", dest="tables", nargs="+", choices=list(TABLES), metavar="TABLE")
        which = one.add_mutually_exclusive_group(required=name == "run")
        which.add_argument("--batch", metavar="YYYY-MM-DD",
                           help="one landed date" + ("; without it, all that are landed" if name == "load" else ""))
        if name == "run":
            which.add_argument("--new-files", action="store_true", help="every batch with files that are new, rewritten or gone")
            one.add_argument("--as-of", type=date.fromisoformat, default=date.today(), metavar="YYYY-MM-DD")
            one.add_argument("--full-refresh", action="store_true")
            one.add_argument("--latest-dimensions", action="store_true")
    return top


def loads_as_text(batch: str | None, loads: list[LoadResult]) -> str:
    """One line a table: landed, loaded and rejected rows."""
    lines = [f"{'batch':<12}{'table':<20}{'landed':>12}{'loaded':>12}{'rejected':>12}"]
    lines += [f"{batch or 'all':<12}{r.table:<20}{r.rows_loaded + r.rows_errored:>12}{r.rows_loaded:>12}{r.rows_errored:>12}"
              for r in loads]
    return "\n".join(lines)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("roadbook")
    if args.command == "load":
        loads = load_all(spark, args.landing, Warehouse(spark, args.warehouse), args.tables, args.batch)
    elif args.new_files:
        loads = pipeline.run_new_files(spark, args.landing, args.warehouse, args.as_of, args.tables,
                                       latest_dimensions=args.latest_dimensions).loads
    else:
        loads = pipeline.run(spark, args.landing, args.warehouse, args.batch, args.as_of, args.tables,
                             full_refresh=args.full_refresh, latest_dimensions=args.latest_dimensions).loads
    print(loads_as_text(args.batch, loads))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
