"""Operator 2: near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if their inner product exceeds a
height. The directions are random product codes: space is rotated and cut into
``BLOCKS`` parts, each part has a few random unit vectors, and a direction is one
of them from every part. List decoding finds all directions that a vector
passes: of the two halves of the parts it keeps the beginnings that the best
ending can lift above the height, and joins them. Vectors of a label meet on the
filters they share; a pair is counted once, on the first filter both pass, and
verified by cosine in double precision.

The code's size follows the number of different vectors, so that a filter holds
about as many of them at any input size, and the height follows the code's size,
so that a vector passes about ``PASSED`` filters of each code; one that passes
fewer than ``LEAST`` lowers its own height. Several codes, each with a rotation
of its own, find what one of them misses.

Equal vectors are one row before they are filtered, with their number. A filter
that holds more than ``MEETING`` of them is dealt over blocks, of which each two
meet in one place, so no task holds an unbounded group. Tasks hand on counts of
links and a spanning forest of them, never all pairs.

Defined results: a vector that is null or zero or holds null or non-finite
components, and one without a label, links with nothing and is its own
component; so do vectors of different lengths with each other; repeated rows are
rows of their own and link as equal vectors do; an empty table gives an empty
table; columns other than id, vector and label are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship, type_of, workers
from roadbook.llm.components import Forest, components

THRESHOLD = 0.98
BLOCKS = 4
# Directions for each different vector; filters a vector passes in each code, about and at least; codes.
DIRECTIONS, PASSED, LEAST, CODES = 2, 8, 4, 2
# Different vectors of a filter that meet in one place, and pairs verified at a time.
MEETING, VERIFIED = 1024, 1 << 17
# Numbers that a half of the code's sums may hold at a time.
SUMS = 1 << 22
SEED = 20240917


class ProductCode:
    """Random directions, each put together from one unit vector of every part of a rotated space."""

    def __init__(self, length: int, directions: int, seed: int):
        rng = np.random.default_rng([SEED, seed, length])
        self.rotation = np.linalg.qr(rng.standard_normal((length, length)))[0]
        parts = np.array_split(np.arange(length), min(BLOCKS, length))
        self.parts = [slice(p[0], p[-1] + 1) for p in parts]
        each = max(2, math.ceil(directions ** (1 / len(parts))))
        words = [rng.standard_normal((each, len(p))) for p in parts]
        self.words = [w / np.linalg.norm(w, axis=1, keepdims=True) / math.sqrt(len(parts)) for w in words]
        self.size = each ** len(parts)
        self.height = NormalDist().inv_cdf(max(0.5, 1 - PASSED / self.size)) / math.sqrt(length)

    def passed(self, unit: np.ndarray) -> list[list[int]]:
        """The numbers of all directions that each unit vector passes, worked out for some rows at a time."""
        wide = len(self.words[0]) ** ((len(self.parts) + 1) // 2)
        some = max(1, SUMS // wide)
        return [found for at in range(0, len(unit), some) for found in self._passed(unit[at: at + some])]

    def _passed(self, unit: np.ndarray) -> list[list[int]]:
        turned = unit @ self.rotation
        scores = [turned[:, p] @ w.T for p, w in zip(self.parts, self.words)]
        half = (len(scores) + 1) // 2
        begin, end = _sums(scores[:half], len(unit)), _sums(scores[half:], len(unit))
        most_begin, most_end = begin.max(axis=1), end.max(axis=1)
        return [self._decode(b, e, mb, me) for b, e, mb, me in zip(begin, end, most_begin, most_end)]

    def _decode(self, begin: np.ndarray, end: np.ndarray, most_begin: float, most_end: float) -> list[int]:
        height = min(self.height, most_begin + most_end)
        while True:
            i, j = np.flatnonzero(begin >= height - most_end), np.flatnonzero(end >= height - most_begin)
            a, b = np.nonzero(begin[i][:, None] + end[j] >= height)
            if len(a) >= min(LEAST, self.size):
                return (i[a] * len(end) + j[b]).tolist()
            height -= 0.05 * abs(height) + 1e-3


def _sums(scores: list[np.ndarray], n: int) -> np.ndarray:
    total = np.zeros((n, 1))
    for s in scores:
        total = (total[:, :, None] + s[:, None, :]).reshape(n, -1)
    return total


_codes: dict[tuple, ProductCode] = {}


def code(length: int, directions: int, number: int) -> ProductCode:
    key = (length, directions, number)
    if key not in _codes:
        _codes.clear() if len(_codes) > 16 else None
        _codes[key] = ProductCode(*key)
    return _codes[key]


def usable(vector: str) -> Column:
    """Whether all components are there and finite and one is not zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows as doubles of length one; scaled first, so that no square over- or underflows."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _filter_rows(points: DataFrame, directions: int) -> DataFrame:
    """A row for each vector and filter it passes, with all its filters in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["length"].to_numpy()
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                unit = _units(part["vector"].values.to_numpy().reshape(len(part), -1))
                filters: list[list[int]] = [[] for _ in range(len(part))]
                for number in range(CODES):
                    own = code(int(length), directions, number)
                    for to, passed in zip(filters, own.passed(unit)):
                        to += [number * own.size + f for f in sorted(passed)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(filters, pa.list_(pa.int64()))],
                                                 names=[*part.schema.names, "filters"])

    schema = f"pid long, label string, length int, copies long, vector {type_of(points, 'vector')}, filters array<long>"
    return points.mapInArrow(work, schema).withColumn("filter", F.explode("filters"))


def _met(rows: DataFrame) -> DataFrame:
    """Rows keyed by where they meet: the filter, and of a full filter each two of its blocks."""
    where = ["label", "length", "filter"]
    full = (rows.groupBy(*where).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MEETING)
            .select(*[F.col(c).alias(f"full_{c}") for c in where], F.ceil(F.col("n") / MEETING).cast("int").alias("blocks")))
    same = [F.col(c) == F.col(f"full_{c}") for c in where]
    block = F.pmod(F.xxhash64("pid"), F.coalesce("blocks", F.lit(1))).cast("int")
    return (
        rows.join(full, same, "left").withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        .select(*where, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                "block", "pid", "copies", "vector", "filters"))


_PLACE = ["label", "length", "filter", "low", "high"]


def _links(met: DataFrame, threshold: float, parts: int) -> DataFrame:
    """``a, b, links``: with b a link of the forest; without, links of a that were counted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            starts = _starts(rows)
            rest = rows.slice(starts[-1])  # the last place may go on in the next batch
            if starts[-1]:
                yield from compared(rows.slice(0, starts[-1]), starts[:-1])
        if rest is not None:
            yield from compared(rest, _starts(rest))

    def compared(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        ends = np.append(starts[1:], len(rows))
        later = np.repeat(ends, ends - starts) - np.arange(len(rows)) - 1  # rows of the place behind each
        pid, copies = rows["pid"].to_numpy(), rows["copies"].to_numpy()
        block, low, high = (rows[c].to_numpy() for c in ("block", "low", "high"))
        column, filters = rows["vector"].chunk(0), rows["filter"].to_numpy()
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
        sets: dict[int, set] = {}
        lists = rows["filters"].chunk(0)
        counts = np.zeros(len(rows), np.int64)
        forest, kept = Forest(), []
        at = np.flatnonzero(later)
        cuts = np.cumsum(later[at])
        for first in _cut(cuts, VERIFIED):
            some = at[first]
            left = np.repeat(some, later[some])
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later[some]) - later[some], later[some])
            meets = (low[left] == high[left]) | (block[left] != block[right])
            left, right = left[meets], right[meets]
            for length in np.unique(rows["length"].to_numpy()[left]):
                mine = rows["length"].to_numpy()[left] == length
                l, r = left[mine], right[mine]
                places, where = np.unique(np.concatenate((l, r)), return_inverse=True)
                unit = _units(values[offsets[places][:, None] + np.arange(length)])
                near = np.einsum("ij,ij->i", unit[where[:len(l)]], unit[where[len(l):]]) >= threshold
                for a, b in zip(l[near].tolist(), r[near].tolist()):
                    for x in (a, b):
                        if x not in sets:
                            sets[x] = set(lists[x].as_py())
                    if min(sets[a] & sets[b]) == filters[a]:  # else they have been counted on an earlier one
                        counts[a] += copies[b]
                        counts[b] += copies[a]
                        if forest.join(int(pid[a]), int(pid[b])):
                            kept.append((pid[a], pid[b], 0))
        linked = np.flatnonzero(counts)
        out = [(pid[i], None, counts[i]) for i in linked.tolist()] + kept
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)], names=["a", "b", "links"])

    dealt = met.repartition(parts, *_PLACE).sortWithinPartitions(*_PLACE, "pid")
    return dealt.mapInArrow(work, "a long, b long, links long")


def _starts(rows: pa.Table) -> np.ndarray:
    """Where a new place begins."""
    new = np.zeros(len(rows), bool)
    new[0] = True
    for c in _PLACE:
        values = rows[c].combine_chunks()
        values = values.dictionary_encode().indices.to_numpy() if c == "label" else values.to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _cut(ends: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows whose pairs are about ``most``."""
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield slice(start, end)
        start = end


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD) -> DataFrame:
    """``id, n_links, component_id`` for every row: links to other rows of the label, smallest id reachable."""
    spark = df.sparkSession
    ship(spark)
    scratch = Scratch(spark, "caps")
    # floats travel as floats, half the bytes, and are compared as doubles
    number = "float" if type_of(df, vector_col) == "array<float>" else "double"
    vector = F.col(vector_col).cast(f"array<{number}>")
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), vector.alias("vector"))
    rows = rows.withColumn("usable", usable("vector") & F.col("label").isNotNull())
    # adding zero makes one zero of the two
    good = rows.where("usable").withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast(number)))
    points = scratch.keep(
        good.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"))
        .select(F.monotonically_increasing_id().alias("pid"), "label", F.size("vector").alias("length"), "copies", "vector", "first"))
    n = points.count()
    filtered = scratch.keep(_filter_rows(points.drop("first"), max(64, DIRECTIONS * n)))
    found = scratch.keep(_links(_met(filtered), threshold, 2 * workers(spark)))
    scratch.drop(filtered)
    joined = components(found.where("b is not null"), scratch)
    links = found.where("links > 0").groupBy(F.col("a").alias("linked")).agg(F.sum("links").alias("links"))
    marked = (points.join(joined, F.col("pid") == F.col("node"), "left")
              .join(links, F.col("pid") == F.col("linked"), "left")
              .withColumn("component", F.coalesce("component", "pid")))
    least = marked.groupBy(F.col("component").alias("of")).agg(F.min("first").alias("component_id"))
    told = scratch.keep(marked.join(least, F.col("component") == F.col("of")).select(
        F.col("label").alias("p_label"), F.col("vector").alias("p_vector"), "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    linked = good.join(told, (F.col("label") == F.col("p_label")) & (F.col("vector") == F.col("p_vector"))).select(
        F.col("id").alias(id_col), "n_links", "component_id")
    alone = rows.where("not usable").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                                            F.col("id").alias("component_id"))
    return linked.unionByName(alone)
