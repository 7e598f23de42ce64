"""Operator 3 against a loop over all pairs, and its parts against plain versions."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from roadbook.llm import simhash
from roadbook.llm.common import Scratch
from roadbook.llm.components import components
from roadbook.llm.queries import QUERIES

from .conftest import TEXTS, TINY


def plain_print(text: str | None, k: int = 3) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(words[i: i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], radius: int = 2) -> list[int]:
    """The place of the first row of each row's component."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def test_query_equals_all_pairs(spark, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    prints = [plain_print(t) for _, t in rows]
    expected = {i: (f"{p:016x}", rows[g][0]) for (i, _), p, g in zip(rows, prints, plain_components(prints))}
    ours = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op3_simhash"](spark, TINY).collect()}
    assert ours == expected


def test_strange_texts(spark, strange, monkeypatch):
    monkeypatch.setattr(simhash, "HASHED", 1000)
    assert [simhash.fingerprint((t or "").encode()) for t in TEXTS] == [plain_print(t) for t in TEXTS]
    assert simhash.near_duplicates(strange).count() == strange.count()
    kept = simhash.deduplicate(strange)
    assert kept.schema == strange.schema
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(
        {r.component_id for r in simhash.near_duplicates(strange).collect()} - {None})
    assert ids.count(None) == 1
    assert simhash.deduplicate(strange.limit(0)).count() == 0


def test_links_in_crowded_tiles(spark, monkeypatch):
    """Random fingerprints and their neighbours, in tiles of three."""
    monkeypatch.setattr(simhash, "TILE", 3)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64) for _ in range(4)]
    near = [base, base ^ flips[0], base ^ flips[0] ^ flips[1], base ^ flips[1] ^ flips[2] ^ flips[3]]
    prints = sorted({int(x) for x in np.concatenate(near)})
    rows = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long")
    scratch = Scratch(spark, "test")
    found = components(simhash.links(rows, scratch), scratch).collect()
    ours = {}
    for r in found:
        ours.setdefault(r.component, set()).add(r.node % 2**64)
    group = plain_components(prints)
    expected = {}
    for p, g in zip(prints, group):
        expected.setdefault(g, set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(sorted(s) for s in expected.values() if len(s) > 1)


def test_components_of_a_long_path(spark):
    edges = spark.range(300).selectExpr("id * 7 % 301 a", "(id + 1) * 7 % 301 b")
    assert {r.component for r in components(edges, Scratch(spark, "test")).collect()} == {0}
    assert components(edges.limit(0), Scratch(spark, "test")).count() == 0


def test_texts_that_share_an_id_are_judged_by_themselves(spark):
    """Unlinked texts under one id stay, each once; a copy of a smaller id's text goes under any id; any column names."""
    rows = [(1, "alpha beta gamma delta epsilon", 1), (1, "quite another text with other words in it", 2), (1, "alpha beta gamma delta epsilon", 3),
            (2, "quite another text with other words in it", 4), (2, "a third text that nobody else has at all", 5),
            (None, "alpha beta gamma delta epsilon", 6), (None, "a text without any id whatever it says", 7),
            (None, "a text without any id whatever it says", 8), (3, None, 9), (3, "", 10)]
    df = spark.createDataFrame([(*r, r[2], r[2]) for r in rows], "doc_id long, text string, __simhash_print int, `group` int, `c 0.x` int")
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    got = {(r.doc_id, r.text) for r in kept.collect()}
    assert kept.count() == len(got) == 5
    assert {g for g in got if g[1]} == {(1, rows[0][1]), (1, rows[1][1]), (2, rows[4][1]), (None, rows[6][1])}
    assert all(r["c 0.x"] == r["group"] == r["__simhash_print"] for r in kept.collect())
