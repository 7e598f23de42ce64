"""Operator 7 against SQL and, on strange rows, against a plain queue in Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

from compare import connect, difference
from roadbook.llm import mixing
from roadbook.llm.queries import ORACLE_SQL, QUERIES

from .conftest import TINY


def test_query_equals_sql(spark):
    assert difference(QUERIES["op7_mixing"](spark, TINY), connect(TINY), ORACLE_SQL["op7_mixing"]) is None


def plain_targets(sizes: dict, weights=(3, 1, 2), share=Fraction(3, 2), epochs=2) -> dict:
    """Share by weight, stop full sources, share the rest again, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    goal, open_, left = dict.fromkeys(order, Fraction(0)), set(order), sum(sizes.values()) * share
    while open_ and left > 0:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit >= epochs * sizes[s]}
        if not full:
            for s in open_:
                goal[s] = weight[s] * unit
            break
        for s in full:
            goal[s] = Fraction(epochs * sizes[s])
            left -= goal[s]
        open_ -= full
    return goal


def plain(rows: list[tuple]) -> list[tuple]:
    """(id, source, size) to (id, size, turns), in one list and one loop."""
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    goal = plain_targets(dict(sizes))
    rank = {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    queues = defaultdict(list)
    for row in rows:
        key = hashlib.md5(("" if row[0] is None else str(row[0])).encode()).hexdigest()
        queues[row[1]].append((key, row[0] or 0, row[2], row))
    copies, turns = [], Counter()
    for source, queue in queues.items():
        upto = 0
        for n, (*_, row) in enumerate(sorted(queue, key=lambda x: x[:3])):
            upto += row[2]
            for epoch in range(2):
                if row[2]:
                    copies.append((float(upto + epoch * sizes[source]) / float(goal[source]), rank[source], n, row))
    taken, budget = 0, sum(sizes.values()) * Fraction(3, 2)
    for _, r, n, row in sorted(copies, key=lambda c: c[:2]):
        taken += row[2]
        if taken > budget:
            break
        turns[r, n] += 1
    return sorted(((row[0] is None, row[0] or 0), row[2], turns[rank[s], n])
                  for s, q in queues.items() for n, (*_, row) in enumerate(sorted(q, key=lambda x: x[:3])))


def as_rows(df):
    count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    return [(r.doc_id, r.source, count(r.text)) for r in df.select("doc_id", "source", "text").collect()]


def test_strange_rows_equal_a_plain_queue(spark, strange):
    ours = mixing.queue(strange).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r["size"], r.turns) for r in ours) == plain(as_rows(strange))


def test_targets_and_limits(spark, documents):
    rows = mixing.queue(documents).collect()
    goal = plain_targets({r.source: r.source_size for r in rows})
    longest, taken = Counter(), Counter()
    for r in rows:
        assert abs(r.target - float(goal[r.source])) < 1e-6 and r.turns in (0, 1, 2)
        longest[r.source] = max(longest[r.source], r["size"])
        taken[r.source] += r["size"] * r.turns
    for source in taken:
        assert abs(taken[source] - goal[source]) <= 2 * max(longest.values())


def test_mix_repeats_rows_and_keeps_their_columns(spark, strange):
    turns = Counter()
    for r in mixing.queue(strange).collect():
        turns[r.doc_id] += r.turns
    mixed = mixing.mix(strange)
    assert mixed.schema == strange.schema
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == +turns


def test_empty_and_wordless(spark, strange):
    assert mixing.queue(strange.limit(0)).count() == 0 and mixing.mix(strange.limit(0)).count() == 0
    wordless = strange.where("text = '' or text = ' '")
    assert [(r.target, r.turns) for r in mixing.queue(wordless).collect()] == [(0.0, 0)] * 2
