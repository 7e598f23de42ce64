"""Operator 5 against longest match over the whole vocabulary, and against a plain greedy loop."""

from __future__ import annotations

import random
import re

import pytest

from roadbook.llm import token_counts as tc
from roadbook.llm.queries import PIECES, QUERIES
from roadbook.llm.sentencepiece_codec import read_model

from .conftest import TINY


@pytest.fixture(scope="module")
def vocabulary():
    return tc.word_pieces(read_model(PIECES))


def greedy(word: str, beginnings: set[str], rests: set[str]) -> int:
    at, n, longest = 0, 0, max(map(len, beginnings | rests))
    while at < len(word):
        known = beginnings if at == 0 else rests
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in known), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_small_vocabularies_equal_a_greedy_loop():
    rng = random.Random(0)
    for _ in range(60):
        piece = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
        beginnings, rests = {piece() for _ in range(rng.randint(1, 6))}, {piece() for _ in range(rng.randint(0, 6))}
        automaton = tc.Automaton(beginnings, rests)
        for _ in range(80):
            word = "".join(rng.choice("aabbc") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, beginnings, rests), (beginnings, rests, word)


def test_strange_texts(spark, strange, vocabulary, monkeypatch):
    beginnings, rests = map(set, vocabulary)
    expected = []
    for r in strange.collect():
        counts = [greedy(w, beginnings, rests) for w in re.findall("[^\x20\x09-\x0d]+", r.text or "") ] if len(r.text or "") < 10**5 else None
        if counts is not None:
            expected.append((r.doc_id is None, r.doc_id or 0, len(counts), sum(max(1, c) if c >= 0 else 1 for c in counts), counts.count(-1)))
    found = tc.token_counts(strange, *vocabulary).collect()
    assert len(found) == strange.count()
    ours = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_tokens, r.n_unknown) for r in found if r.doc_id != 11)
    assert ours == sorted(expected)
    assert {r.n_words for r in found if r.doc_id == 11} == {30_000}
    assert tc.token_counts(strange.limit(0), *vocabulary).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    own = tc.WordCounts(["a", "ab"], ["b", "c"])
    for _ in range(2):
        for words in (["a", "ab", "abc"], ["abb", "x", "a", "", "abc"], ["cab"]):
            assert own.of(tc.pa.array(words)).tolist() == [greedy(w, {"a", "ab"}, {"b", "c"}) for w in words]


def whole_vocabulary(word: str, pieces: set[str]) -> int:
    """Longest match over the word behind its space, by every piece of the model; -1 if it cannot be spelt."""
    text, at, n, longest = "\u2581" + word, 0, 0, max(map(len, pieces))
    while at < len(text):
        end = next((e for e in range(min(len(text), at + longest), at, -1)
                    if text[at:e] in pieces and "\u2581" not in text[max(at, 1):e]), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return {lib.id_to_piece(i) for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}


def test_query_equals_longest_match_over_the_whole_vocabulary(spark, documents, pieces):
    known: dict[str, int] = {}
    expected = {}
    for r in documents.collect():
        words = re.findall("[^\x20\x09-\x0d]+", r.text or "")
        counts = [known[w] if w in known else known.setdefault(w, whole_vocabulary(w, pieces)) for w in words]
        expected[r.doc_id] = (len(words), sum(1 if c < 0 else c for c in counts), counts.count(-1))
    assert {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in QUERIES["op5_token_counts"](spark, TINY).collect()} == expected


def test_a_word_may_begin_with_the_space_alone(vocabulary, pieces):
    automaton = tc.Automaton(*vocabulary)
    for word in ("9", "9000426309966109$$$", "ñandú", "ça", "être", "ßen", "the", "2024-01-15"):
        assert automaton.count(word) == whole_vocabulary(word, pieces) > 0
    assert automaton.count("9") == 2


def test_small_vocabularies_with_an_empty_beginning():
    rng = random.Random(1)
    for _ in range(60):
        piece = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
        beginnings, rests = {piece() for _ in range(rng.randint(0, 6))}, {piece() for _ in range(rng.randint(0, 6))}
        automaton = tc.Automaton([*beginnings, ""], rests)
        pieces = {"\u2581" + b for b in beginnings} | {"\u2581"} | rests
        for _ in range(80):
            word = "".join(rng.choice("aabbc") for _ in range(rng.randint(1, 14)))
            assert automaton.count(word) == whole_vocabulary(word, pieces), (beginnings, rests, word)
