"""Operator 12: vector codes by exact ball k-means on each part of the vectors.

Vectors become whole numbers and are cut into equal parts; each part position has
a codebook, and a part's code is its nearest entry's index. An entry and the parts
that held its index last form a ball: its radius is the farthest part's distance
from the entry as it is now. Entries whose distance from it is more than twice the
radius are no neighbours and are never looked at. By the triangle inequality a part
at distance d can only move to neighbours within 2 d: parts with no neighbour that
near are the stable core and stay without work, the others lie in annular rings,
each with the few nearest neighbours that its parts are compared with. Squares of
whole numbers decide all of it, so results, ties included, are those of comparing
with every entry. At first all parts are in the ball of entry 0.

Spark runs a pass over the vectors for each round: tasks sum their parts by entry,
the sums of all tasks are added, and the entries (a bounded table: positions times
entries) go back with the next pass. Vectors with their last codes are written
between rounds, in the shared folder.

Defined results: vectors that are null or hold null or non-finite components are
left out; fewer kept vectors than entries make a shorter codebook; ties of the
smallest ids are settled by the vectors themselves, a null id comes last; repeated
rows are rows of their own; an empty table gives an empty table; other columns come
along only if asked for. Vectors must be of one length, a multiple of the parts, and
components below 2**27 once scaled: others stop the job with a message.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadbook.llm.common import Scratch, ship

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
LARGEST = 2**27

_VECTOR, _CODE, _ERROR = "_ball_vector", "_ball_code", "_ball_error"


class Balls:
    """The entries of one part position, each with its neighbours by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(apart, -1)  # itself first, then the others, equal ones by index
        self.neighbours = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.neighbours, axis=1)

    def rings(self, ball: np.ndarray, own: np.ndarray) -> np.ndarray:
        """How many of its ball's neighbours each part must be compared with; 0 in the stable core."""
        ring = np.zeros(len(own), np.int64)
        order = np.argsort(ball, kind="stable")
        inside, starts = np.unique(ball[order], return_index=True)
        for i, members in zip(inside.tolist(), np.split(order, starts[1:])):
            near = self.apart[i]
            radius = own[members].max()
            near = near[:np.searchsorted(near, 4 * radius, side="right")]  # the ball's neighbours
            ring[members] = np.searchsorted(near, 4 * own[members], side="right")
        return ring

    def nearest(self, x: np.ndarray, ball: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry, the lowest of equals, and its squared distance."""
        own = ((x - self.entries[ball]) ** 2).sum(axis=1)
        ring = self.rings(ball, own)
        code, best = ball.copy(), own.copy()
        moving = np.argsort(-ring, kind="stable")
        reach = -ring[moving]  # ascending
        for t in range(int(ring.max(initial=0))):
            active = moving[:np.searchsorted(reach, -t)]  # those with more than t neighbours to see
            other = self.neighbours[ball[active], t]
            far = ((x[active] - self.entries[other]) ** 2).sum(axis=1)
            nearer = (far < best[active]) | (far == best[active]) & (other < code[active])
            won = active[nearer]
            code[won], best[won] = other[nearer], far[nearer]
        return code, best


def _whole(column: pa.Array, parts: int, scale: float) -> np.ndarray:
    """Vectors as whole numbers: row, part, position."""
    lengths = pc.list_value_length(column).to_numpy()
    if len(lengths) and (lengths != lengths[0]).any() or len(lengths) and lengths[0] % parts:
        raise ValueError(f"vectors must be of one length, a multiple of {parts}: found {sorted(set(lengths.tolist()))[:5]}")
    x = np.floor(scale * column.flatten().to_numpy().astype(np.float64))
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a component times {scale} is {x[np.abs(x).argmax()]}; the largest that squares exactly is below {LARGEST}")
    return x.astype(np.int64).reshape(len(column), parts, int(lengths[0]) // parts if len(lengths) else 0)


def _codes(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The codes that the rows held last; the first entry if none yet."""
    if _CODE not in batch.schema.names:
        return np.zeros((batch.num_rows, parts), np.int64)
    return np.frombuffer(b"".join(batch[_CODE].to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)


def _assign(batches: Iterator[pa.RecordBatch], books: np.ndarray, scale: float, keep_vector: bool) -> Iterator[pa.RecordBatch]:
    """The rows with their codes and squared errors."""
    parts = len(books)
    balls = [Balls(entries) for entries in books]
    for batch in batches:
        x, code = _whole(batch[_VECTOR], parts, scale), _codes(batch, parts)
        if batch.num_rows and x.shape[2] != books.shape[2]:
            raise ValueError("vectors must be of one length")
        error = np.zeros(batch.num_rows, np.int64)
        for p in range(parts):
            code[:, p], best = balls[p].nearest(x[:, p], code[:, p])
            error += best
        kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns)
                if n not in (_CODE, _ERROR) and (keep_vector or n != _VECTOR)]
        packed = code.astype(np.uint8)
        coded = pa.array([row.tobytes() for row in packed], pa.binary())
        yield pa.RecordBatch.from_arrays([c for _, c in kept] + [coded, pa.array(error)], names=[n for n, _ in kept] + [_CODE, _ERROR])


def _sums(batches: Iterator[pa.RecordBatch], parts: int, entries: int, width: int, scale: float) -> Iterator[pa.RecordBatch]:
    """For each part position and entry of one task: how many parts, and their sums."""
    count = np.zeros(parts * entries, np.int64)
    total = np.zeros((parts * entries, width), np.int64)
    for batch in batches:
        x, code = _whole(batch[_VECTOR], parts, scale), _codes(batch, parts)
        for p in range(parts):
            place = p * entries + code[:, p]
            count += np.bincount(place, minlength=len(count))
            np.add.at(total, place, x[:, p])
    used = np.flatnonzero(count)
    sums = [pa.array(total[used, i]) for i in range(width)]
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), *sums], names=["place", "n", *[f"s{i}" for i in range(width)]])


def _finite(vector: str) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (),
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Each vector's ``code`` (a byte a part) and ``error``, with its id and the kept columns; and the codebooks."""
    spark = df.sparkSession
    ship(spark)
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    if clash := {"code", "error"} & {id_col, *keep}:
        raise ValueError(f"{sorted(clash)} would be given twice")
    scratch = Scratch(spark, "balls")
    rows = df.where(F.col(vector_col).isNotNull() & _finite(vector_col)).select(
        id_col, *keep, F.col(vector_col).alias(_VECTOR))
    first = rows.orderBy(F.asc_nulls_last(id_col), _VECTOR).limit(entries).select(_VECTOR).toArrow()[_VECTOR].combine_chunks()
    books = np.swapaxes(_whole(first, parts, scale), 0, 1) if len(first) else np.zeros((parts, 0, 0), np.int64)
    books = np.ascontiguousarray(books)
    made = [T.StructField(_CODE, T.BinaryType()), T.StructField(_ERROR, T.LongType())]
    with_vector = T.StructType([*rows.schema, *made])
    without = T.StructType([*[f for f in rows.schema if f.name != _VECTOR], *made])
    if not len(first):
        empty = rows.select(id_col, *keep, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return empty, books

    size, width = books.shape[1], books.shape[2]
    step = "place long, n long" + "".join(f", s{i} long" for i in range(width))
    for _ in range(rounds):
        now = scratch.keep(rows.mapInArrow(lambda b, c=books: _assign(b, c, scale, True), with_vector))
        if hasattr(rows, "_scratch_path"):
            scratch.drop(rows)
        rows = now
        found = (rows.select(_VECTOR, _CODE).mapInArrow(lambda b: _sums(b, parts, size, width, scale), step)
                 .groupBy("place").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).collect())
        books = books.copy()
        for r in found:  # at most one row for each entry of each position
            books[r.place // size, r.place % size] = [r[f"s{i}"] // r.n for i in range(width)]
    coded = scratch.keep(rows.mapInArrow(lambda b, c=books: _assign(b, c, scale, False), without)
                         .withColumnsRenamed({_CODE: "code", _ERROR: "error"}))
    if hasattr(rows, "_scratch_path"):
        scratch.drop(rows)
    return coded, books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_group_error(coded: DataFrame, group: str, name: str) -> DataFrame:
    """The error summed over equal values of a column, nulls together; a common value is summed before it is shuffled."""
    totals = coded.groupBy(F.col(group).alias("_group")).agg(F.sum("error").alias(name))
    return coded.join(totals, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
