"""Run the named queries and their SQL side by side on one data directory."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if Path(path).exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), "" if v is None else v) for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r[n] for n in names) for r in df.collect()), key=_sortable)


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=_sortable)


def same_value(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def difference(df, con, sql: str) -> str | None:
    """None when columns, row count and every value agree exactly."""
    names, ours = spark_rows(df)
    other_names, theirs = sql_rows(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if not all(map(same_value, a, b))]
    return f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from roadbook.session import build_session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark: SparkSession = build_session("compare", "local[8]", spark__sql__shuffle__partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(directory), contract.oracle_sql()
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        problem = difference(build(spark, directory), con, sql[name]) if name in sql else "no oracle"
        print(f"{name:35s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
