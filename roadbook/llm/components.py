"""Connected components by stars, for graphs that no single task could hold.

Each round points every node at the smallest of its neighbours, first for the
larger ones (large star), then for the smaller ones (small star), until nothing
changes; a graph of n nodes takes a number of rounds that grows with log n, not
with its diameter. Minima are combined before their shuffle and a hub's edges
are joined, never gathered, so that a join may split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch


class Forest:
    """Which nodes some links join, within one task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the link joins what was not joined."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v`` with ``m``, the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("_u"), F.least("u", "v").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with an edge: the smallest node of its component."""
    now = scratch.keep(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                       .where("u <> v").distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        small = _with_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        was, now = now, scratch.keep(small)
        scratch.drop(was)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
