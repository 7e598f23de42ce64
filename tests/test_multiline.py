"""Rows put together from split lines must be those of the reader that takes a file whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from roadbook.schemas import TABLES
from roadbook.sources import landing, multiline
from roadbook.sources.landing import CORRUPT

HEAD = "log_id,vehicle_id,service_type,service_date,cost_usd,mileage_at_service,technician,notes"


def whole(spark, path):
    """Spark's multiLine reader, one task a file."""
    options = landing.csv_options("maintenance_logs") | {"multiLine": "true"}
    return spark.read.schema(TABLES["maintenance_logs"].string_schema(CORRUPT)).options(**options).csv(str(path))


def split(spark, path):
    rows = multiline.without_header(multiline.split_rows(multiline.read_lines_of(spark, str(path))))
    return landing.read_lines(rows.withColumnRenamed("row", "line"), "maintenance_logs")


def contents(df):
    return sorted((tuple(r) for r in df.select(*TABLES["maintenance_logs"].names, CORRUPT).collect()), key=str)


def same(spark, tmp_path, text, name="f.csv", **conf):
    path = tmp_path / name
    path.write_bytes(text.encode())
    set_, before = spark.conf.set, {}
    for key, value in conf.items():
        key = key.replace("__", ".")
        before[key] = spark.conf.get(key)
        set_(key, value)
    try:
        got, expected = contents(split(spark, path)), contents(whole(spark, path))
        splits = split(spark, path).rdd.getNumPartitions() if not conf else multiline.read_lines_of(spark, str(path)).rdd.getNumPartitions()
    finally:
        for key, value in before.items():
            set_(key, value)
    assert got == expected
    return expected, splits


def row(i, notes, vehicle="V"):
    return f"L{i},{vehicle},oil,2024-01-02,10.5,5000,T,{notes}"


@pytest.mark.parametrize("notes", [
    ["plain", '"two\nlines"', "x"],
    ['"doubled "" quote"', '"""all"""', '""', '"a\n""\nb"', '"""\n"""', '"\n"', '"\n\n\n"'],
    ['"commas, and\n, more, ""x"", y"', 'a"b', 'un"quoted "text', "'single\"", "tail"],
    ['"then"text', '"then"te"xt', '"a""b"c', "x", '"a\nb"rest'],
    ['"crlf\r\ninside"', "after"],
    ["", '"ends with quote"""', '"""begins"'],
])
def test_dialect(spark, tmp_path, notes):
    lines = [HEAD, *[row(i, n) for i, n in enumerate(notes)], row(99, "last")]
    for end, final in (("\n", ""), ("\r\n", "\r\n")):
        rows, _ = same(spark, tmp_path, end.join(lines) + final, f"f{len(end)}.csv")
        assert len(rows) >= 2


def test_the_first_line_tells_how_lines_end(spark, tmp_path):
    same(spark, tmp_path, f'{HEAD}\n{row(1, chr(34) + "p" + chr(13) + chr(10) + "q" + chr(34))}\n{row(2, "y")}\r\n{row(3, "z")}\n')
    same(spark, tmp_path, f'{HEAD}\r\n{row(1, chr(34) + "p" + chr(10) + "q" + chr(13) + "r" + chr(34))}\r\n{row(2, "y")}\r\n', "a.csv")


def test_empty_lines_headers_and_short_rows(spark, tmp_path):
    same(spark, tmp_path, HEAD)
    same(spark, tmp_path, HEAD + "\n", "a.csv")
    same(spark, tmp_path, "", "b.csv")
    same(spark, tmp_path, f"\n\n{HEAD}\n\n{row(1, 'x')}\n\n\n" + row(2, '"y\n\nz"') + "\n\n", "c.csv")
    same(spark, tmp_path, f"{HEAD}\n   \n{row(1, 'x')}\n \n\t\n", "s.csv")
    same(spark, tmp_path, f'{HEAD}\nL1,V\n{row(2, "a,b,c")}\n"L3\nx",V,"oil\n"\n', "d.csv")


def random_rows(seed, n):
    rng = random.Random(seed)
    bits = ['""', "\n", ",", "x", "word ", '"",', ',""', "\n\n", "é漢", '""""']

    def notes():
        if rng.random() < 0.5:
            return "".join(rng.choice(["a", " b", "c'"]) for _ in range(rng.randint(0, 9)))
        return '"' + "".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) + '"'

    return "\n".join([HEAD, *[row(i, notes(), notes()) for i in range(n)]]) + "\n"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_file_in_many_splits(spark, tmp_path, seed):
    """Splits of about 1,000 bytes: newlines, quotes and commas at their ends, and rows over several of them."""
    text = random_rows(seed, 700) + row(9000, '"' + "long line\n" * 600 + '"') + "\n" + row(9001, "end") + "\n"
    rows, splits = same(spark, tmp_path, text, spark__sql__files__maxPartitionBytes="1000", spark__sql__files__openCostInBytes="1")
    assert splits >= 30 and len(rows) > 600


def test_several_files_keep_their_columns(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        path = tmp_path / landing.landing_key("maintenance_logs", day, "f.csv")
        path.parent.mkdir(parents=True)
        path.write_text("\n".join([HEAD, row(day, '"a\nb"'), row(day, "c")]) + "\n")
    rows = landing.read_landed(spark, str(tmp_path), "maintenance_logs")
    assert sorted((r.log_id, str(r.date), r.notes) for r in rows.collect()) == [
        (f"L{d}", d, n) for d in ("2024-01-01", "2024-01-02") for n in ("a\nb", "c")]
    assert rows.columns == [*TABLES["maintenance_logs"].names, CORRUPT, "date"]


def test_no_task_takes_a_whole_file(spark, tmp_path):
    """A file of many splits is read, ordered and put together by splits."""
    path = tmp_path / "f.csv"
    path.write_text("\n".join([HEAD, *[row(i, '"a\nb"') for i in range(20_000)]]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = multiline.read_lines_of(spark, str(path))
        assert lines.rdd.getNumPartitions() >= 8
        sizes = [r["count"] for r in lines.groupBy("split").count().collect()]
        assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4
        assert split(spark, path).where(F.col("notes") == "a\nb").count() == 20_000
        plan = split(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
