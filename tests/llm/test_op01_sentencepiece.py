"""Operator 1 against the library itself, and its decoding against the text."""

from __future__ import annotations

import hashlib

import pytest
import sentencepiece

from roadbook.llm import sentencepiece_codec as sc
from roadbook.llm.queries import PIECES, QUERIES

from .conftest import TINY, TEXTS


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_query_equals_the_library(spark, documents, library):
    theirs = {}
    for row in documents.select("doc_id", "text").collect():
        ids = library.encode(row.text or "")
        theirs[row.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256(library.decode(ids).encode()).hexdigest())
    ours = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_sentencepiece"](spark, TINY).collect()}
    assert ours == theirs


def test_strange_texts(spark, strange, library):
    model = sc.read_model(PIECES)
    ours = sc.encode_decode(strange, model).collect()
    texts = strange.select("doc_id", "text").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), r.decoded) for r in ours) == sorted(
        (t.doc_id is None, t.doc_id or 0, library.encode(t.text or ""), library.decode(library.encode(t.text or "")))
        for t in texts)
    assert sc.encode_decode(strange.limit(0), model).count() == 0


def test_heap_and_arrays_agree(library):
    own = sc.PieceCodec(sc.read_model(PIECES))
    units = ["", "hello", " spaced", "abababab" * 9, "été", "zzzz"]
    ids, lengths = own.work_out(units)
    assert [tuple(x) for x in __import__("numpy").split(ids, lengths.cumsum()[:-1])] == [own.merge(u) for u in units]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(sc, "REMEMBERED", 5)
    own = sc.PieceCodec(sc.read_model(PIECES))
    pa = sc.pa
    for _ in range(3):
        for text in [t for t in TEXTS if t is not None]:
            ids, _ = own.encode(pa.array([text]))
            assert ids.tolist() == library.encode(text)


def test_a_difference_is_not_passed_over(library):
    own = sc.PieceCodec(sc.read_model(PIECES))
    with pytest.raises(RuntimeError):
        own.compare(["hello"], sc.np.array([5, 6]), sc.np.array([2]))
