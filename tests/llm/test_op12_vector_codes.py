"""Operator 12 against SQL, and against comparing every part with every entry."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from compare import connect, difference

from roadbook.llm import vector_codes
from roadbook.llm.queries import ORACLE_SQL, QUERIES

from .conftest import TINY

NAN, INF = float("nan"), float("inf")


def test_query_equals_sql(spark):
    assert difference(QUERIES["op12_vector_codes"](spark, TINY), connect(TINY), ORACLE_SQL["op12_vector_codes"]) is None


def plain(rows, parts, entries, rounds):
    """Codes and errors by id, and the codebooks, by plain loops."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [(i, [v[p * width:(p + 1) * width] for p in range(parts)]) for i, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width:(p + 1) * width] for _, v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, p: min((far(x, e), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        moved = []
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, x in cut:
                members[nearest(x[p], p)[1]].append(x[p])
            moved.append([[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(members, books[p])])
        books = moved
    found = [[nearest(x[p], p) for p in range(parts)] for _, x in cut]
    return sorted((str(i), bytes(j for _, j in f).hex(), sum(d for d, _ in f)) for (i, _), f in zip(cut, found)), books


def ours(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v, "l", "c") for i, v in rows], "vec_id long, embedding array<float>, label string, code string")
    coded, books = vector_codes.encode(df.repartition(3), **sizes)
    return sorted((str(r.vec_id), bytes(r.code).hex(), r.error) for r in coded.collect()), books.tolist()


def vectors(seed, n, width, spread):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    return [(i, [np.float32(c + rng.gauss(0, spread)).item() for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 0.01, 0.4])
def test_equals_all_comparisons(spark, spread):
    """Copies of few vectors (all ties), tight and loose clouds."""
    rows, sizes = vectors(3, 150, 12, spread), dict(parts=3, entries=20, rounds=3)
    assert ours(spark, rows, **sizes) == plain(rows, **sizes)


def test_strange_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.001, 0.0, 0.5]) for _ in range(6)]) for i in range(60)]
    rows += [rows[5], (5, [9.0] * 6), (None, [1.0] * 6), (None, [-1.0] * 6), (70, None), (71, [1.0, None] * 3), (72, [NAN] * 6), (73, [INF] * 6)]
    sizes = dict(parts=2, entries=64, rounds=2)
    assert ours(spark, rows, **sizes) == plain(rows, **sizes)


def test_few_and_no_vectors(spark):
    sizes = dict(parts=2, entries=8, rounds=2)
    assert ours(spark, [(3, [1.0, 2.0]), (2, [0.0, 1.0])], **sizes) == plain([(3, [1.0, 2.0]), (2, [0.0, 1.0])], **sizes)
    assert ours(spark, [], **sizes)[0] == [] and ours(spark, [(1, None)], **sizes)[0] == []
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    coded, books = vector_codes.encode(df, keep=("label",))
    assert vector_codes.with_group_error(coded, "label", "e").count() == 0 and len(vector_codes.digest(books)) == 64


def test_refused(spark):
    for rows, text in (([(1, [1.0, 2.0]), (2, [1.0])], "length"), ([(1, [1.0, 1e9])], "largest")):
        with pytest.raises(Exception, match=text):
            ours(spark, rows, parts=1)
    with pytest.raises(ValueError, match="twice"):
        vector_codes.encode(spark.createDataFrame([], "vec_id long, embedding array<float>, code int"), keep=("code",))


def test_group_error(spark):
    coded = spark.createDataFrame([(1, None, 3), (2, None, 4), (3, 1, 5), (4, 1, 6), (5, 2, 7)], "id int, label int, error long")
    got = {(r.id, r.total) for r in vector_codes.with_group_error(coded, "label", "total").collect()}
    assert got == {(1, 7), (2, 7), (3, 11), (4, 11), (5, 7)}


def test_cores_and_rings_spare_work():
    """Parts near their entry see no other entry, the others few; nothing changes in the result."""
    rng = np.random.default_rng(2)
    entries = rng.integers(-400, 400, (64, 4))
    x = entries[rng.integers(0, 64, 5000)] + rng.integers(-40, 41, (5000, 4))
    balls = vector_codes.Balls(entries)
    every = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    code, best = balls.nearest(x, np.zeros(len(x), np.int64))
    assert (code == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    again, _ = balls.nearest(x, code)
    ring = balls.rings(code, best)
    assert (again == code).all() and (ring == 0).mean() > 0.5 and ring.mean() < 2
