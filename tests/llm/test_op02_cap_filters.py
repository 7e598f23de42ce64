"""Operator 2 against all pairs, with planted copies, and its list decoding against all directions."""

from __future__ import annotations

import numpy as np
import pytest

from roadbook.llm import cap_filters
from roadbook.llm.common import table
from roadbook.llm.queries import QUERIES

from .conftest import TINY


def plain(rows, threshold=0.98):
    """id -> (links, component) from all pairs."""
    n, links = len(rows), [0] * len(rows)
    group = list(range(n))
    units = []
    for _, v, label in rows:
        good = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float64) if good else None
        units.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if good else None)
    for i in range(n):
        for j in range(i):
            if (units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and rows[i][2] == rows[j][2]
                    and units[i] @ units[j] >= threshold):
                links[i] += 1
                links[j] += 1
                if group[i] != group[j]:
                    a, b = group[i], group[j]
                    group = [a if g == b else g for g in group]
    least = {g: min(rows[i][0] for i in range(n) if group[i] == g) for g in set(group)}
    return sorted((rows[i][0], links[i], least[group[i]]) for i in range(n))


def ours(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, pid int, first string")
    return sorted(tuple(r) for r in cap_filters.near_vectors(df).collect())


@pytest.fixture(scope="module")
def planted(spark):
    """The tiny table, and near copies, copies and a tight cluster of some of its vectors."""
    rng = np.random.default_rng(5)
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table(spark, TINY, "embeddings").limit(150).collect()]
    for n, (_, v, label) in enumerate(rows[:60]):
        near = np.float32(np.array(v) + rng.normal(0, 0.0235 if n % 2 else 0.01, len(v)))
        rows.append((1000 + n, [float(x) for x in near], label))
    rows += [(2000 + n, rows[3][1], rows[3][2]) for n in range(20)]
    rows += [(3000 + n, [float(x) for x in np.float32(np.array(rows[9][1]) + rng.normal(0, 0.004, 64))], rows[9][2]) for n in range(40)]
    return rows


def test_planted_copies(spark, planted):
    assert ours(spark, planted) == plain(planted)


def test_full_filters_are_dealt_over_blocks(spark, planted, monkeypatch):
    monkeypatch.setattr(cap_filters, "MEETING", 4)
    monkeypatch.setattr(cap_filters, "VERIFIED", 50)
    assert ours(spark, planted) == plain(planted)


def test_strange_vectors(spark):
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, -0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, -0.0], 1), (9, [2.0, 0.0], 1), (10, [1e30, 1e28], 1),
            (11, [1e-30, 0.0], 1), (12, [1.0, 0.0], 2), (13, [1.0, 0.0, 0.0], 1), (14, [3.0], 1), (15, [5.0], 1), (16, [-5.0], 1)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == []


def test_list_decoding_finds_every_direction():
    code = cap_filters.ProductCode(20, 5000, 1)
    rng = np.random.default_rng(0)
    unit = rng.normal(size=(50, 20))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turned = unit @ code.rotation
    all_scores = cap_filters._sums([turned[:, p] @ w.T for p, w in zip(code.parts, code.words)], 50)
    for passed, scores in zip(code.passed(unit), all_scores):
        above = set(np.flatnonzero(scores >= code.height + 1e-12).tolist())
        assert above <= set(passed) and len(passed) >= cap_filters.LEAST
        if len(above) >= cap_filters.LEAST:
            assert len(passed) <= len(np.flatnonzero(scores >= code.height - 1e-12))


def test_query_columns(spark):
    rows = QUERIES["op2_cap_filters"](spark, TINY)
    assert rows.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows.count() == table(spark, TINY, "embeddings").count()


def test_rows_are_decoded_in_slices(monkeypatch):
    own = cap_filters.code(16, 4096, 0)
    rng = np.random.default_rng(3)
    unit = cap_filters._units(rng.standard_normal((50, 16)))
    whole = own.passed(unit)
    monkeypatch.setattr(cap_filters, "SUMS", 3 * len(own.words[0]) ** 2)
    assert own.passed(unit) == whole and len(whole) == 50


def test_floats_and_doubles_link_alike(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 16)).astype(np.float32)
    near = (base + 0.01 * rng.standard_normal((30, 16))).astype(np.float32)
    rows = [(i, [float(x) for x in v], i % 30 % 2) for i, v in enumerate([*base, *near, *base[:5]])]
    found = [sorted(map(tuple, cap_filters.near_vectors(spark.createDataFrame(
        rows, f"vec_id long, embedding array<{kind}>, label int")).collect())) for kind in ("float", "double")]
    assert found[0] == found[1] and sum(n > 0 for _, n, _ in found[0]) >= 60
