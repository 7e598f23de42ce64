"""Read CSV whose quoted fields hold newlines, one file by many tasks.

Spark's own reader gives such a file to one task, since a newline may or may not end
a row. Here a file is read as lines, split wherever Spark splits it. Whether a line
begins inside a quoted field follows from the lines before it, and those only matter
through one bit; so each line is a function of that bit: it may keep it, flip it, or
set it whatever it was. Functions are composed: within a split by running sums, over
the splits of a file by running sums over one row a split. Then every line knows how
it begins, every row where it starts, and only rows of several lines are gathered.

A line's function comes from its quotes, by the rules of the reader: a quote opens a
field only where the field begins, a doubled one inside is text, and what follows a
closing quote is text up to the next delimiter.

A file's lines end as its first one does, with ``\\n`` or ``\\r\\n``; in a file of the
latter kind a lone ``\\n`` outside of quotes ends a row too. A row's text must fit a task, as everywhere; a
split of lines is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_END = r"\r\z"  # what is left of a line's end
LINES = "file string, split bigint, at bigint, line string"


def read_lines_of(spark: SparkSession, path: str, base: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``file, split, at, line``: the lines of files, where their split begins, and their order within it."""
    reader = spark.read.option("lineSep", "\n")
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"), *keep)


def _ends_inside(text: Column, inside: bool) -> Column:
    """Whether a line ends within quotes, if it begins outside or inside them.

    Without doubled quotes each one left closes the field it is in, or opens one where a delimiter stands
    before it; the line's beginning counts as a delimiter if a row begins there.
    """
    plain = F.replace(text, F.lit('""'), F.lit(""))
    pieces = F.split(plain if inside else F.concat(F.lit(","), plain), '"', -1)
    before_quotes = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.aggregate(before_quotes, F.lit(inside), lambda within, piece: ~within & F.endswith(piece, F.lit(",")))


def _functions(lines: DataFrame) -> DataFrame:
    """Add ``sets``, the bit that a line ends with whatever it begins with, or NULL, and ``flips``, whether it changes it."""
    quoted = F.contains("line", F.lit('"'))
    outside, inside = (F.when(quoted, _ends_inside(F.col("line"), b)).otherwise(F.lit(b)) for b in (False, True))
    return lines.withColumn("_outside", outside).withColumn("_inside", inside).select(
        *lines.columns, F.when(F.col("_outside") == F.col("_inside"), F.col("_outside")).alias("sets"),
        (F.col("_outside") & ~F.col("_inside")).cast("int").alias("flips"))


def _begins(first: Column, order: Window) -> Column:
    """The bit that a row of functions begins with, if the first one begins with ``first``.

    It is what the last one that sets it set, or ``first``, changed by an odd number of flips since.
    """
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum("flips").over(earlier), F.lit(0))
    setting = F.struct("sets", F.col("_till").alias("till"))
    last = F.last(F.when(F.col("sets").isNotNull(), setting), ignorenulls=True).over(earlier)
    since = flips - F.coalesce(last["till"], F.lit(0))
    return F.coalesce(last["sets"], first) != (since % 2 == 1)


def _with_till(rows: DataFrame, order: Window) -> DataFrame:
    """Add ``_till``, the flips up to and with a row."""
    return rows.withColumn("_till", F.sum("flips").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def split_rows(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``file, split, nth, row``: the whole rows of files, by where they start; empty lines between rows are none.

    ``keep`` names columns that are alike for all lines of a file.
    """
    in_split = Window.partitionBy("file", "split").orderBy("at")
    in_file = Window.partitionBy("file").orderBy("split")
    told = _with_till(_functions(lines), in_split)

    # a split as one function: what its last setting line set, flipped by the lines since
    ends = told.groupBy("file", "split").agg(
        F.max_by(F.struct("sets", "_till"), F.when(F.col("sets").isNotNull(), F.col("at"))).alias("_set"),
        F.sum("flips").alias("_flips"), F.min_by(F.endswith("line", F.lit("\r")), "at").alias("_cr"))
    odd = (F.col("_flips") - F.coalesce(F.col("_set")["_till"], F.lit(0))) % 2 == 1
    ends = ends.select("file", "split", "_cr", (F.col("_set")["sets"] != odd).alias("sets"),
                       F.when(F.col("_set").isNull(), odd.cast("int")).otherwise(0).alias("flips"))
    splits = _with_till(ends, in_file).select("file", "split", _begins(F.lit(False), in_file).alias("_first"),
                                              F.first("_cr").over(in_file).alias("_crlf"))

    # one row a split meets its lines on the key that they are dealt by already
    known = told.join(splits, ["file", "split"]).withColumn("inside", _begins(F.col("_first"), in_split))
    closes = F.when(F.col("sets").isNotNull(), ~F.col("sets")).otherwise(F.col("inside") == (F.col("flips") == 1))
    text = F.when(F.col("_crlf"), F.regexp_replace("line", _END, "")).otherwise(F.col("line"))
    starts = ~F.col("inside") & (F.col("text") != "")
    numbered = known.withColumn("text", text).select(
        "file", "split", "at", "text", *keep, "inside", closes.alias("closes"), starts.alias("starts"),
        F.sum(starts.cast("long")).over(in_split).alias("nth"))
    numbered = numbered.where(F.col("inside") | F.col("starts"))
    single = numbered.where(F.col("starts") & F.col("closes")).select("file", "split", "nth", *keep, F.col("text").alias("row"))

    # a row of several lines is named by its first one; lines at the head of a split belong to the last row begun before it
    several = numbered.where(~(F.col("starts") & F.col("closes")))
    last_rows = numbered.groupBy("file", "split").agg(F.max(F.when(F.col("nth") > 0, F.struct("split", "nth"))).alias("_last"))
    before = last_rows.select("file", "split", F.last("_last", ignorenulls=True).over(
        in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_open"))
    owned = several.join(before, ["file", "split"]).withColumn(
        "_row", F.when(F.col("nth") > 0, F.struct("split", "nth")).otherwise(F.col("_open")))
    parts = F.sort_array(F.collect_list(F.struct("split", "at", "text")))
    gathered = owned.groupBy("file", "_row").agg(parts.alias("_parts"), *[F.first(c).alias(c) for c in keep]).select(
        "file", "_row.split", "_row.nth", *keep,
        F.array_join(F.transform("_parts", lambda p: p["text"]), "\n").alias("row"))
    return single.unionByName(gathered)


def without_header(rows: DataFrame) -> DataFrame:
    """The rows but each file's first."""
    return rows.where((F.col("split") > 0) | (F.col("nth") > 1))
