"""Operator 6 against SQL, and against all products on strange vectors."""

from __future__ import annotations

import math
import random

from compare import connect, difference
from pyspark.sql import functions as F

from roadbook.llm import voronoi_topk
from roadbook.llm.queries import ORACLE_SQL, QUERIES

from .conftest import TINY

NAN, INF = float("nan"), float("inf")


def test_query_equals_sql(spark):
    assert difference(QUERIES["op6_voronoi_topk"](spark, TINY), connect(TINY), ORACLE_SQL["op6_voronoi_topk"]) is None


def plain(rows, k=5, scale=256.0):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in usable if i is not None and i % 50 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, x)), j if j is not None else 2**63 - 1)
                        for j, x in usable if j != i and len(x) == len(q))
        out += [(i, rank + 1, j if j < 2**63 - 1 else None, -s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def ours(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "l", 1) for i, v in rows], "vec_id long, embedding array<float>, length string, cell int")
    found = voronoi_topk.top_k(df, F.col("vec_id") % 50 == 0, k=k)
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()), key=str)


def test_strange_vectors(spark):
    rng = random.Random(3)
    some = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(160)]  # many ties
    some += [some[100], some[7], (200, None), (250, [1.0, None, 0.0]), (201, [NAN, 0.0, 1.0]), (202, [INF, 0.0, 1.0]),
             (300, [0.0, 0.0, 0.0]), (350, [1.0, 2.0]), (351, [2.0, 1.0]), (400, []), (None, [1.0, 1.0, 1.0]), (450, [9.0] * 7)]
    assert ours(spark, some) == plain(some)


def test_cells_and_blocks(spark, monkeypatch):
    """Clustered vectors, cells with more queries than a block holds, and slices of a few rows."""
    for name, value in (("QUERIES", 3), ("ROWS", 40), ("MOST_PIVOTS", 6)):
        monkeypatch.setattr(voronoi_topk, name, value)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 5) for _ in range(4)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 5]]) for i in range(0, 1600, 2)]
    rows = [(i, [float(x) for x in __import__("numpy").float32(v)]) for i, v in rows]
    assert ours(spark, rows, k=3) == plain(rows, k=3)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e7, 1.0]), (1, [1e7, -1.0]), (2, [1e7, 2.0]), (50, [-1e7, 1.0])]
    assert ours(spark, rows) == plain(rows)


def test_few_or_no_rows(spark):
    assert ours(spark, []) == [] and ours(spark, [(0, [1.0])]) == [] and ours(spark, [(1, [1.0])]) == []
    assert ours(spark, [(0, [1.0]), (50, [2.0])]) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
