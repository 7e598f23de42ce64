"""Operator 7: mixing sources to target weights, as weighted fair queueing.

Sources, in code-point order with the null source last, weigh 3, 1, 2 and so on,
and share ``share`` times all words; a target stops at ``epochs`` times its
source's words and the excess is shared again by weight. The documents of a
source stand in a shuffled queue that is gone through ``epochs`` times. A copy's
virtual finish time is the source's words up to and with it over the source's
target. All copies are ranged by finish time and the mix is cut at the budget.

Only DataFrame functions. A source is never one task: its queue is cut into
65,536 buckets by the shuffle key, so running sums are taken within a bucket and
over the buckets' totals; the same is done for the whole mix over ranges of
finish time, of which only the one that holds the cut is looked into row by row.

Defined results: a null or empty text has size 0 and takes nothing; repeated
rows are rows of their own; with no words at all every target is 0; an empty
table gives an empty table; other columns, whatever their names, are not used.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, numbered

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
EPOCHS = 2
# Ranges of finish time for each doubling of it.
RANGES = 4096
_RUNNING = (Window.unboundedPreceding, Window.currentRow)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffle_key(id_col: str) -> Column:
    """A key that shuffles documents alike in every run and engine."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size`` to those with ``rank, target, budget``; one row a source.

    Going up by limit over weight, the words left over each weight left rise while
    sources are full and fall from the first that is not: their highest value is
    the level at which all sources that are not full stand.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    left = F.col("budget") - (F.sum("limit").over(by_level.rowsBetween(*_RUNNING)) - F.col("limit"))
    weight_left = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        sizes.withColumn("rank", F.row_number().over(by_name).cast("long") - 1)
        .withColumn("weight", weight)
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(share.numerator) / F.lit(share.denominator))
        .withColumn("limit", (F.col("source_size") * epochs).cast("double"))
        .withColumn("level", left / weight_left)
        .withColumn("target", F.least("limit", F.col("weight") * F.max("level").over(whole)))
        .select("source", "source_size", "rank", "target", "budget")
    )


def queue(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, share: Fraction = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Every row's place in the mix: ``size, source_size, target, first_finish, turns``.

    ``turns`` says how many times the mix takes the row; its copy of epoch e
    finishes at ``first_finish + e * source_size / target``.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    rows = scratch.keep(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                  words(F.col(text_col)).alias("size"), shuffle_key(id_col).alias("key"))
                        .withColumn("bucket", F.substring("key", 1, 4)))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    goals = scratch.keep(targets(sizes, weights, share, epochs))
    ahead = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(*_RUNNING))
    starts = (buckets.withColumn("ahead", ahead - F.col("bucket_size"))
              .join(goals.withColumnRenamed("source", "goal_source"), F.col("source").eqNullSafe(F.col("goal_source")))
              .drop("goal_source").withColumnsRenamed({"source": "start_source", "bucket": "start_bucket"}))

    within = Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(*_RUNNING)
    queued = (
        rows.join(starts, F.col("source").eqNullSafe(F.col("start_source")) & (F.col("bucket") == F.col("start_bucket")))
        .withColumn("upto", F.col("ahead") + F.sum("size").over(within))
        .select("id", "source", "size", "source_size", "target", "rank", "budget", "upto")
    )
    queued = scratch.keep(queued)

    copies = (
        queued.where("size > 0")
        .select("size", "rank", "budget", F.explode(F.array(*[finish(e) for e in range(epochs)])).alias("at"))
        .withColumn("range", F.floor(F.log2("at") * RANGES))
    )
    ranges = copies.groupBy("range", "budget").agg(F.sum("size").alias("range_size"))
    upto = F.sum("range_size").over(Window.orderBy("range").rowsBetween(*_RUNNING))
    cut_range = (ranges.withColumn("upto", upto).where("upto > budget").orderBy("range").limit(1)
                 .select(F.col("range").alias("cut_range"), (F.col("upto") - F.col("range_size")).alias("before")))
    inside = F.col("before") + F.sum("size").over(Window.orderBy("at", "rank").rowsBetween(*_RUNNING))
    cut = (
        copies.join(cut_range, F.col("range") == F.col("cut_range"))
        .withColumn("inside", inside)
        # the last copy that fits; where none does, the range's start stands for it
        .agg(F.max(F.when(F.col("inside") <= F.col("budget"), F.struct("at", "rank"))).alias("last"),
             F.max("cut_range").alias("cut_range"))
    )
    cut = scratch.keep(cut)  # one row

    def taken(epoch: int) -> Column:
        at = finish(epoch)
        in_range = F.floor(F.log2(at) * RANGES)
        fits = (F.struct(at.alias("at"), F.col("rank")) <= F.col("last")) & (in_range == F.col("cut_range"))
        before = F.col("cut_range").isNull() | (in_range < F.col("cut_range"))
        return F.when((F.col("size") > 0) & (before | F.coalesce(fits, F.lit(False))), 1).otherwise(0)

    turns = sum((taken(e) for e in range(1, epochs)), taken(0))
    return queued.join(F.broadcast(cut)).select(  # the cut is one row by its aggregation
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        finish(0).alias("first_finish"), turns.alias("turns"))


def finish(epoch: int) -> Column:
    return F.when(F.col("target") > 0, (F.col("upto") + epoch * F.col("source_size")) / F.col("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``df`` that the mix takes, each as often as it takes it, in the order of the mix.

    Repeated rows share an id, so the copies of one id are dealt as a whole: its
    rows are repeated in turn until the id's turns are used up.
    """
    def key(id_, source, size) -> Column:
        return F.md5(F.to_json(F.struct(id_.cast("string").alias("i"), source.cast("string").alias("s"), size.alias("n"))).cast("binary"))

    wanted = df.columns
    df, names = numbered(df)  # a caller's columns may have any names
    id_col, text_col, source_col = names[id_col], names[text_col], names[source_col]
    placed = queue(df, id_col, text_col, source_col, **options)
    same = Window.partitionBy("__mix_of")
    dealt = (
        placed.where("turns > 0")
        .withColumn("__mix_epoch", F.explode(F.sequence(F.lit(1), F.col("turns"))))
        .select(key(F.col(id_col), F.col(source_col), F.col("size")).alias("__mix_of"),
                (F.col("first_finish") + (F.col("__mix_epoch") - 1) * F.col("source_size") / F.col("target")).alias("__mix_finish"))
        .withColumn("__mix_turn", F.row_number().over(same.orderBy("__mix_finish")) - 1))
    # dealt by one key, so that the numbering and the join find the texts where they are
    alike = Window.partitionBy("__mix_key")
    rows = (
        df.withColumn("__mix_key", key(F.col(id_col), F.col(source_col), words(F.col(text_col)))).repartition("__mix_key")
        .withColumns({"__mix_row": F.row_number().over(alike.orderBy(F.xxhash64(text_col))) - 1,
                      "__mix_rows": F.count(F.lit(1)).over(alike)}))
    match = (F.col("__mix_key") == F.col("__mix_of")) & (F.col("__mix_turn") % F.col("__mix_rows") == F.col("__mix_row"))
    return (rows.join(dealt, match).repartitionByRange("__mix_finish", "__mix_key")
            .sortWithinPartitions("__mix_finish", "__mix_key").select(*df.columns).toDF(*wanted))


def _in_sql(text: str) -> str:
    return f"coalesce(len(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')), 0)::bigint"


def sql(documents: str = "documents") -> str:
    """The contract's columns of :func:`queue` in DuckDB's SQL, with the default settings."""
    return f"""
WITH d AS (SELECT doc_id, source, {_in_sql('text')} AS size, md5(coalesce(doc_id::varchar, '')) AS key FROM {documents}),
s AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [3.0::double, 1.0::double, 2.0::double][(rank % 3 + 1)::int] AS weight,
  (sum(source_size) OVER ())::double * 3 / 2 AS budget, (source_size * 2)::double AS lim FROM r),
l AS (SELECT *, (budget - (sum(lim) OVER (ORDER BY lim / weight, rank ROWS UNBOUNDED PRECEDING) - lim))
  / sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(lim, weight * max(level) OVER ()) AS target FROM l),
q AS (SELECT d.doc_id, d.source, size, source_size, target, rank, budget, key,
  sum(size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id, size ROWS UNBOUNDED PRECEDING)::bigint AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (upto + epoch * source_size)::double / target AS fin FROM q, (VALUES (0), (1)) e(epoch) WHERE size > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY fin, rank ROWS UNBOUNDED PRECEDING) <= budget AS fits FROM c),
n AS (SELECT source, upto, sum(CASE WHEN fits THEN size ELSE 0 END)::bigint AS taken FROM m GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, CASE WHEN q.size > 0 THEN coalesce(n.taken, 0) ELSE 0 END::bigint AS taken
FROM q LEFT JOIN n ON q.source IS NOT DISTINCT FROM n.source AND q.upto = n.upto AND q.size > 0"""
