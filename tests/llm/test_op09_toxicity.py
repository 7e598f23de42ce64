"""Operator 9: held-out accuracy, the chain's order, and strange rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadbook.llm import toxicity
from roadbook.llm.common import table
from roadbook.llm.queries import QUERIES

from .conftest import TINY

SMALL = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Fitted on the labels of even ids, judged on those of odd ids."""
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    chain, figures = toxicity.train(documents, labels.where("doc_id % 2 = 0"), toxicity.categories())
    judged = toxicity.score(documents, chain).join(labels.where("doc_id % 2 = 1"), "doc_id")
    counts = {(r.toxic, r.is_toxic): r["count"] for r in judged.groupBy("toxic", "is_toxic").count().collect()}
    caught, missed = counts.get((1, True), 0), counts.get((1, False), 0)
    wrongly, clean = counts.get((0, True), 0), counts.get((0, False), 0)
    assert caught / (caught + missed) > 0.9 and wrongly / (wrongly + clean) < 0.015
    assert figures["toxic"]["rows"] <= toxicity.SAMPLE


def test_query_gives_every_document_once_and_alike(spark, documents):
    one, two = ({tuple(r) for r in QUERIES["op9_toxicity"](spark, TINY).collect()} for _ in range(2))
    assert one == two and {r[0] for r in one} == {r.doc_id for r in documents.collect()}


def test_a_later_category_uses_an_earlier_one():
    """The second label equals the first, which features tell; without features of its own it still is told."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (400, 6)).astype(np.float32)
    y = np.column_stack([x[:, 0], x[:, 0]])
    weights, offsets, held = toxicity.fit_chain(np.hstack([x, np.zeros((400, toxicity.SHARES + 2), np.float32)]), y, np.arange(400) % toxicity.FOLDS, 6)
    assert weights[1][-1] > 0.5
    assert ((held[:, 1] > 0.5) == (y[:, 1] == 1)).all()


def test_folds_hold_rows_out():
    """Labels that nothing tells: predictions of rows a model had seen would follow them."""
    rng = np.random.default_rng(1)
    x = np.hstack([np.eye(200, dtype=np.float32), np.zeros((200, toxicity.SHARES + 1), np.float32)])
    y = rng.integers(0, 2, (200, 1)).astype(float)
    _, _, held = toxicity.fit_chain(x, y, np.arange(200) % toxicity.FOLDS, 200)
    assert np.ptp(held) < 0.3


@pytest.mark.parametrize("p, y, low, high", [([0.9, 0.2, 0.1], [1, 1, 0], 0.1, 0.2), ([], [], 0.5, 0.5), ([0.3], [0], 0.5, 0.5)])
def test_threshold(p, y, low, high):
    assert low <= toxicity.threshold(np.array(p), np.array(y, float)) <= high


def test_strange_rows(spark, strange):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 0, 0), (5, 1, 1), (6, None, 1), (99, 1, 1), (None, 1, 1), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(strange, labels, toxicity.categories(), "doc_id", "text", 10).collect()
    assert sorted((r.id, r.y0, r.y1) for r in sample) == [(3, 0, 1), (4, 1, 0), (5, 0, 1), (7, 0, 0)]
    chain, _ = toxicity.train(strange, labels, toxicity.categories())
    rows = toxicity.score(strange, chain).collect()
    assert len(rows) == strange.count() and all(0 <= r.p_toxic <= 1 for r in rows)
    for none in (labels.limit(0), labels.where("toxic = 0 and quality = 1")):
        chain, _ = toxicity.train(strange, none, toxicity.categories())
        assert {r.is_toxic for r in toxicity.score(strange, chain).collect()} == {False}
    assert toxicity.score(strange.limit(0), chain).count() == 0
    kept = toxicity.score(strange.withColumnRenamed("size", "is_toxic"), chain, keep=["doc_id", "is_toxic"])
    assert kept.columns == ["doc_id", "is_toxic", "_p_poor", "_is_poor", "_p_toxic", "_is_toxic"] and kept.count()
    kept = toxicity.score(strange, chain, keep=strange.columns)
    assert kept.columns[: len(strange.columns)] == strange.columns
