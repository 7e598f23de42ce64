"""Operator 4: gradients against differences, scores against a plain loop, held-out likelihood against frequencies."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from roadbook.llm import pseudo_likelihood as pl
from roadbook.llm.common import table
from roadbook.llm.queries import QUERIES

from .conftest import TINY

SMALL = "/root/testdata/sf0.01"


def plain(text, tokens: pl.Tokens, net: pl.Network) -> float:
    """One word after the other, the network written out."""
    common = tokens.common.to_pylist()
    words = [w for w in (text or "").lower().split() if w]
    numbers = [common.index(w) if w in common else len(common) + pl.zlib.crc32(w[-3:].encode()) % pl.CLASSES for w in words]
    total = 0.0
    for i, number in enumerate(numbers):
        inner = net.inner_bias.astype(np.float64).copy()
        for k, d in enumerate([d for d in range(-pl.SIDE, pl.SIDE + 1) if d]):
            near = numbers[i + d] if 0 <= i + d < len(numbers) else tokens.size
            inner += net.embedding[near].astype(np.float64) @ net.inner[k]
        logits = np.tanh(inner) @ net.outer + net.outer_bias
        total += logits[number] - math.log(np.exp(logits).sum())
    return total


@pytest.fixture(scope="module")
def trained(spark):
    documents = table(spark, SMALL, "documents")
    return pl.train(documents.where("doc_id % 5 <> 0"))


def test_scores_equal_a_plain_loop(spark, documents, trained):
    some = documents.limit(25)
    ours = {r.doc_id: r for r in pl.score(some, *trained).collect()}
    for r in some.collect():
        assert ours[r.doc_id].log_likelihood == pytest.approx(plain(r.text, *trained), rel=1e-4, abs=1e-3)
        assert ours[r.doc_id].n_tokens == len(r.text.lower().split())


def test_held_out_documents_are_likelier_than_by_frequency(spark, trained):
    tokens, network = trained
    held = table(spark, SMALL, "documents").where("doc_id % 5 = 0")
    found = pl.score(held, tokens, network).selectExpr("sum(log_likelihood) / sum(n_tokens)").first()[0]
    seen = Counter()
    for r in table(spark, SMALL, "documents").where("doc_id % 5 <> 0").collect():
        seen.update(tokens.split(pl.pa.array([r.text]))[0].tolist())
    numbers = np.concatenate([tokens.split(pl.pa.array([r.text]))[0] for r in held.collect()])
    shares = np.array([seen[i] + 1 for i in range(tokens.size)])
    assert found > np.log(shares / shares.sum())[numbers].mean() + 0.02


def test_steps_follow_the_gradient():
    rng = np.random.default_rng(2)
    size = 9
    start = pl.Network.start(rng.integers(1, 9, size).astype(float)).flat().astype(np.float64)
    around, tokens = rng.integers(0, size + 1, (40, 2 * pl.SIDE)), rng.integers(0, size, 40)
    loss = lambda flat: -pl.Network.from_flat(flat, size).log_probabilities(around, tokens).mean()
    net = pl.Network.from_flat(start, size)
    net.learn(around, tokens, 1.0)
    gradient = start - net.flat()
    for place in rng.integers(0, len(start), 40):
        step = np.zeros(len(start))
        step[place] = 1e-2
        assert gradient[place] == pytest.approx((loss(start + step) - loss(start - step)) / 2e-2, abs=2e-3)


def test_the_token_itself_is_masked(trained):
    tokens, _ = trained
    around = tokens.around(np.array([5, 6, 7]), np.array([1, 2]))
    assert 5 not in around[0] and around.tolist()[1] == [tokens.size, tokens.size, 7, tokens.size]


def test_common_words_are_those_of_the_whole_corpus(spark, documents):
    seen = Counter(w for r in documents.collect() for w in (r.text or "").lower().split())
    assert {r.word: r.n for r in pl.count_words(documents).collect()} == seen


def test_query_and_repeats(spark, documents):
    one, two = ({tuple(r) for r in QUERIES["op4_pseudo_likelihood"](spark, TINY).collect()} for _ in range(2))
    assert one == two and {r[0] for r in one} == {r.doc_id for r in documents.collect()}


def test_strange_texts(spark, strange, trained):
    rows = pl.score(strange, *trained).collect()
    assert len(rows) == strange.count()
    for r in rows:
        if r.n_tokens == 0:
            assert r.log_likelihood == 0 and r["mean"] is None
    assert {r.n_tokens for r in rows if r.doc_id == 11} == {30_000}
    alike = [r.log_likelihood for r in rows if r.doc_id in (5, 6)]
    assert len(alike) == 3 and alike == pytest.approx([alike[0]] * 3, rel=1e-5)
    for few in (strange, strange.limit(0), strange.where("text = ''")):
        assert pl.score(few, *pl.train(few)).count() == few.count()


@pytest.mark.parametrize("carried", [0, 40, pl.CARRIED])
def test_each_word_is_scored_as_itself(spark, strange, trained, monkeypatch, carried):
    """Whether its count travels with the task or is joined: the class's score and log P(word | class) by plain counts."""
    monkeypatch.setattr(pl, "CARRIED", carried)
    tokens, network = trained
    seen = table(spark, TINY, "documents").limit(30)
    held = seen.select("doc_id", "text").union(strange.select("doc_id", "text"))
    counted = pl.Scratch(spark, "words").keep(pl.count_words(seen))
    counts = Counter(w for r in seen.collect() for w in (r.text or "").lower().split())
    common, ending = set(tokens.common.to_pylist()), lambda w: pl.zlib.crc32(w[-3:].encode()) % pl.CLASSES
    totals = Counter()
    for w, n in counts.items():
        if w not in common:
            totals[ending(w)] += n
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.log_likelihood)
    ours = sorted(pl.score_words(held, tokens, network, counted).collect(), key=key)
    by_class = {}
    for r in pl.score(held, tokens, network).collect():
        by_class.setdefault((r.doc_id, r.n_tokens), []).append(r.log_likelihood)
    texts = {}
    for r in held.collect():
        words = pl.words_of(pl.pa.array([r.text or ""])).flatten().to_pylist()
        own = sum(math.log(max(1, counts[w]) / (totals[ending(w)] + 1)) for w in words if w not in common)
        texts.setdefault((r.doc_id, len(words)), []).append(own)
    assert len(ours) == held.count()
    for r in ours:
        rest = [r.log_likelihood - b for b in by_class[r.doc_id, r.n_tokens]]
        assert any(x == pytest.approx(y, rel=1e-4, abs=1e-3) for x in rest for y in texts[r.doc_id, r.n_tokens])
        assert r["mean"] == (pytest.approx(r.log_likelihood / r.n_tokens) if r.n_tokens else None)


def test_words_of_one_class_do_not_count_alike(spark):
    """A text whose words are swapped for rarer ones of the same endings scores less."""
    rows = [(i, "the river flows to the sea and the walker follows the river") for i in range(9)]
    swapped = "the qiver flows to the sea and the zalker follows the qiver"
    df = spark.createDataFrame([*rows, (9, swapped)], "doc_id long, text string")
    counted = pl.Scratch(spark, "words").keep(pl.count_words(df))
    scores = {r.doc_id: r.log_likelihood for r in pl.score_words(df, *pl.train(df, common=1, counted=counted), counted).collect()}
    assert scores[9] == pytest.approx(scores[0] - 3 * math.log(9), rel=1e-5)
