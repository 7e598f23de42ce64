"""Operator 6: exact top-k by inner product, as a Voronoi join.

Components are whole numbers, so scores are exact. Pivots are taken from the
queries; a query belongs to its nearest pivot's cell, and so does a row. For a
cell with pivot p whose queries lie within distance u of it, every query q
scores a row x between <p,x> - u|x| and <p,x> + u|x|. A first pass summarises
each pair of cells: the k best lower bounds and the highest upper bound. From
these a cell's threshold follows, the k-th best lower bound of all rows: what
cannot reach it cannot be among the k best of any of the cell's queries. The
second pass sends a row only to the cells whose threshold it may reach; there
blocks of queries and rows are solved by one matrix product each, and the k best
of each block are merged.

Nothing is dropped that could be in a result, whatever the data: where bounds
say little, as in high dimensions, rows go to more cells. A cell with many
queries and a cell with many rows are dealt over blocks of bounded size.

Defined results: vectors that are null or hold null or non-finite components
take no part, zero vectors do; components beyond a long's range, and scores, are
held at its ends; vectors of different lengths do not meet; a query that is
repeated with the same vector is asked once; rows with the query's id are not
its candidates, other repeated rows are rows of their own; a candidate without an id
comes last among equals and is given without one; with fewer than k
candidates all are given; an empty table gives an empty table; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship

K = 5
# Queries and rows of a block; pivots for each block of queries, and at most.
QUERIES, ROWS = 2048, 8192
PIVOTS, MOST_PIVOTS = 4, 256
_EXACT = 2.0**53


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, as longs; null where the vector takes no part."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(F.forall(vector, number), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers; held at a long's ends."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if largest * a.shape[1] < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -2**63, 2**63 - 1).astype(np.int64)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), length)


class Cells:
    """Pivots of one vector length, how far their queries lie, and the cells' thresholds."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.float64)
        self.squares = (self.pivots**2).sum(axis=1)
        self.reach = np.zeros(len(pivots))
        self.threshold = np.full(len(pivots), -np.inf)
        self.open = np.ones((len(pivots), len(pivots)), bool)  # row's cell, query's cell

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(np.float64)
        far = (x**2).sum(axis=1)[:, None] - 2 * x @ self.pivots.T + self.squares
        cell = far.argmin(axis=1)
        return cell, np.linalg.norm(x - self.pivots[cell], axis=1)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row and cell the least and the highest score that a query of the cell may give."""
        x = x.astype(np.float64)
        middle = x @ self.pivots.T
        spread = np.linalg.norm(x, axis=1)[:, None] * self.reach
        slack = 1e-9 * (np.abs(middle) + spread) + 1e-6  # more than rounding can take away
        return middle - spread - slack, middle + spread + slack


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        lengths = batch["length"].to_numpy()
        for length in np.unique(lengths).tolist():
            yield length, batch.filter(pa.array(lengths == length))


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of highest inner product for each query."""
    spark = df.sparkSession
    ship(spark)
    scratch = Scratch(spark, "voronoi")
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                      whole(F.col(vector_col), scale).alias("vector"))
            .where("vector is not null").withColumn("length", F.size("vector")))
    queries = scratch.keep(rows.where("asks").select("id", "length", "vector").distinct()
                           .withColumn("query", F.monotonically_increasing_id()))
    cells = _pivots(queries)
    asked = scratch.keep(_in_cells(queries, cells))
    _reach(asked, cells)
    _thresholds(rows, cells, k)

    # a cell's queries are dealt over blocks, all rows over slices
    per_cell = asked.groupBy("length", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("blocks"))
    slices = max(1, -(-rows.count() // ROWS))
    asked = (asked.join(per_cell, ["length", "cell"]).withColumn("block", F.pmod(F.xxhash64("query"), "blocks").cast("int"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    sent = (_sent(rows, cells).join(per_cell, ["length", "cell"])
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")))

    where = ["length", "cell", "block", "slice"]
    met = (asked.select(*where, "query", "id", "vector").groupBy(*where)
           .cogroup(sent.select(*where, "id", "vector").groupBy(*where)))
    best = met.applyInArrow(lambda q, x: _solve(q, x, k), "query long, query_id long, vec_id long, score long, nameless boolean")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "nameless")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("nameless"), F.col("vec_id")).alias("vec_id"), "score"))


def _pivots(queries: DataFrame) -> dict[int, Cells]:
    """For each length the queries with the smallest hashes, a bounded number."""
    cells = {}
    for length, n in queries.groupBy("length").count().collect():
        wanted = min(MOST_PIVOTS, PIVOTS * -(-n // QUERIES))
        chosen = (queries.where(F.col("length") == length).orderBy(F.xxhash64("vector"), "query").limit(wanted)
                  .select("vector").collect())
        cells[length] = Cells(np.array([r.vector for r in chosen], np.int64).reshape(len(chosen), length))
    return cells


def _in_cells(queries: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, part in _by_length(batches):
            cell, far = cells[length].nearest(_matrix(part["vector"], length))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(far)],
                                             names=[*part.schema.names, "cell", "far"])

    return queries.mapInArrow(work, "id long, length int, vector array<long>, query long, cell int, far double")


def _reach(asked: DataFrame, cells: dict[int, Cells]) -> None:
    for length, cell, far in asked.groupBy("length", "cell").agg(F.max("far")).collect():
        cells[length].reach[cell] = far * (1 + 1e-9)


def _thresholds(rows: DataFrame, cells: dict[int, Cells], k: int) -> None:
    """Summaries of each pair of cells, and what follows from them.

    Lower bounds come from rows that ask nothing: none of them is a query's own.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for length, part in _by_length(batches):
            if length not in cells:
                continue
            own, x = cells[length], _matrix(part["vector"], length)
            cell, _ = own.nearest(x)
            least, most = own.bounds(x)
            least[part["asks"].to_numpy(zero_copy_only=False)] = -np.inf
            for j in np.unique(cell).tolist():
                low, high = np.sort(least[cell == j], axis=0)[-k:], most[cell == j].max(axis=0)
                if (length, j) in best:
                    low = np.sort(np.vstack([best[length, j][0], low]), axis=0)[-k:]
                    high = np.maximum(best[length, j][1], high)
                best[length, j] = low, high
        out = [(length, j, i, high[i], low[:, i].tolist()) for (length, j), (low, high) in best.items() for i in range(len(high))]
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], schema=pa.schema(
                [("length", pa.int32()), ("cell", pa.int32()), ("asking", pa.int32()), ("most", pa.float64()),
                 ("least", pa.list_(pa.float64()))]))

    names = ["length", "cell", "asking", "most", "least"]
    found = rows.select("vector", "length", "asks").mapInArrow(
        work, "length int, cell int, asking int, most double, least array<double>")
    highest = found.groupBy("length", "cell", "asking").agg(F.max("most").alias("most")).collect()
    ranked = Window.partitionBy("length", "asking").orderBy(F.desc("low"))
    thresholds = (found.select("length", "asking", F.explode("least").alias("low"))
                  .withColumn("place", F.row_number().over(ranked)).where(F.col("place") == k).collect())
    for r in thresholds:
        cells[r.length].threshold[r.asking] = r.low
    for r in highest:
        cells[r.length].open[r.cell, r.asking] = r.most >= cells[r.length].threshold[r.asking]


def _sent(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """Each row once for every cell whose threshold it may reach."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, part in _by_length(batches):
            if length not in cells:
                continue
            own, x = cells[length], _matrix(part["vector"], length)
            cell, _ = own.nearest(x)
            _, most = own.bounds(x)
            row, asking = np.nonzero((most >= own.threshold) & own.open[cell])
            for start in range(0, len(row), ROWS):
                taken = part.take(pa.array(row[start: start + ROWS]))
                yield pa.RecordBatch.from_arrays(
                    [taken["id"], taken["vector"], taken["length"], pa.array(asking[start: start + ROWS].astype(np.int32))],
                    names=["id", "vector", "length", "cell"])

    return rows.select("id", "vector", "length").mapInArrow(work, "id long, vector array<long>, length int, cell int")


def _solve(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of the block for each of its queries."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    if len(queries) and len(rows):
        length = queries["length"][0].as_py()
        rows = rows.sort_by("id")  # of equal scores the smaller id comes first
        x, ids = _matrix(rows["vector"].combine_chunks(), length), _ids(rows)
        nameless = rows["id"].combine_chunks().is_null().to_numpy(False)
        asks, own = _matrix(queries["vector"].combine_chunks(), length), _ids(queries)
        step = max(1, (1 << 23) // len(x))
        for start in range(0, len(asks), step):
            score = products(asks[start: start + step], x)
            mine = own[start: start + step]
            some = min(k + int(np.unique(ids, return_counts=True)[1].max()), len(x))
            least = np.partition(score, len(x) - some, axis=1)[:, len(x) - some]
            q, r = np.nonzero(score >= least[:, None])
            other = ids[r] != mine[q]
            q, r = q[other], r[other]
            order = np.lexsort((r, -score[q, r].astype(object) if score.min(initial=0) == -2**63 else -score[q, r], q))
            q, r = q[order], r[order]
            first = np.searchsorted(q, q)  # where the query's rows begin
            kept = np.arange(len(q)) - first < k
            q, r = q[kept], r[kept]
            for to, values in zip(out, (queries["query"].to_numpy()[start + q], mine[q], ids[r], score[q, r], nameless[r])):
                to.append(values)
    names = ["query", "query_id", "vec_id", "score", "nameless"]
    return pa.table({n: np.concatenate(o) if o else np.zeros(0, np.int64 if n != "nameless" else bool) for n, o in zip(names, out)})


def _ids(table: pa.Table) -> np.ndarray:
    """Ids as numbers; a row without one has the largest, so it comes last."""
    return table["id"].combine_chunks().fill_null(2**63 - 1).to_numpy()
