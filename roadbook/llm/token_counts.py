"""Operator 5: token counts by a linear longest-match automaton.

Greedy word-piece takes the longest piece at a word's start, then the longest
continuation, and so on. A beginning may be empty: a word that no longer one fits
starts with that piece, which takes none of its letters. A trie over the vocabulary, with one root for a word's
beginning and one for its rest, gets for every node a failure link and the
number of pieces popped on the way along it. A word is then read once, letter by
letter: where the trie has no way on, the popped pieces are counted and the link
is followed. No piece is ever built, and the work is linear in the word's length.

Words are runs of other than the six ASCII white-space characters. A word that
the vocabulary cannot spell is one unknown token, as usual for word-piece.

Defined results: null and empty texts have no words and no tokens; words and
texts may have any length; repeated rows are rows of their own; an empty table
gives an empty table; columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from roadbook.llm.common import ship, type_of
from roadbook.llm.sentencepiece_codec import SPACE, chunks

REMEMBERED = 1_000_000
_NONE = -1


class Automaton:
    """The trie with its failure links and how many pieces each of them pops."""

    ROOT, REST = 0, 1

    def __init__(self, beginnings: Iterable[str], rests: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces in ((self.ROOT, beginnings), (self.REST, rests)):
            for text in pieces:
                node = root
                for c in text:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        piece.append(False)
                    node = self.next[node][c]
                piece[node] |= node > self.REST or root == self.ROOT and not text
        self.link, self.pops = [_NONE] * len(piece), [0] * len(piece)
        if piece[self.ROOT]:
            self.link[self.ROOT], self.pops[self.ROOT] = self.REST, 1
        level = [self.ROOT, self.REST]
        while level:  # breadth first: a link leads to a node that is less deep, or as deep under the other root
            below = []
            for parent in level:
                for c, node in self.next[parent].items():
                    below.append(node)
                    if piece[node]:
                        self.link[node], self.pops[node] = self.REST, 1
                        continue
                    at, pops = self.link[parent], self.pops[parent]
                    while at != _NONE and c not in self.next[at]:
                        pops += self.pops[at]
                        at = self.link[at]
                    if at != _NONE:
                        self.link[node], self.pops[node] = self.next[at][c], pops
            level = below

    def count(self, word: str) -> int:
        """How many pieces the word has; -1 if the vocabulary cannot spell it."""
        after, link, pops = self.next, self.link, self.pops
        node = count = 0
        for c in word:
            while (to := after[node].get(c)) is None:
                count += pops[node]
                node = link[node]
                if node == _NONE:
                    return -1
            node = to
        while node > self.REST:
            count += pops[node]
            node = link[node]
            if node == _NONE:
                return -1
        return count


def word_pieces(model: bytes) -> tuple[list[str], list[str]]:
    """A word-piece vocabulary out of a piece vocabulary: pieces behind a space begin words, others go on.

    The space alone is the empty beginning.
    """
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())
              if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
    return ([p[1:] for p in pieces if p[0] == SPACE and SPACE not in p[1:]],
            [p for p in pieces if SPACE not in p])


class WordCounts:
    """Counts of words, remembered from batch to batch as far as memory is set."""

    def __init__(self, beginnings: list[str], rests: list[str]):
        self.automaton = Automaton(beginnings, rests)
        self.words, self.counts = pa.array([], pa.string()), np.zeros(0, np.int32)

    def of(self, words: pa.StringArray) -> np.ndarray:
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, self.words)
        new = distinct.filter(pc.is_null(at))
        counts = np.zeros(len(distinct), np.int32)
        known = pc.is_valid(at).to_numpy(zero_copy_only=False)
        counts[known] = self.counts[pc.drop_null(at).to_numpy()]
        counts[~known] = made = np.fromiter(map(self.automaton.count, new.to_pylist()), np.int32, len(new))
        if len(self.words) + len(new) > REMEMBERED:
            self.words, self.counts = distinct, counts
        else:
            self.words, self.counts = pa.concat_arrays([self.words, new]), np.concatenate((self.counts, made))
        return counts[coded.indices.to_numpy()]


_counters: dict[int, WordCounts] = {}


def token_counts(df: DataFrame, beginnings: list[str], rests: list[str], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_tokens, n_unknown``: words, word-pieces (an unknown word is one) and unknown words."""
    ship(df.sparkSession)
    key = hash((tuple(beginnings), tuple(rests)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters[key] = WordCounts(beginnings, rests)
        for batch in batches:
            start = 0
            for texts in chunks(pc.fill_null(batch.column(1).cast(pa.string()), "")):
                split = pc.ascii_split_whitespace(texts)
                counts = _counters[key].of(split.flatten())
                ends = np.cumsum(pc.list_value_length(split).to_numpy())
                words = split.flatten()
                totals = [np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[np.concatenate(([0], ends))]
                          for x in (pc.not_equal(words, "").to_numpy(zero_copy_only=False), np.where(counts < 0, 1, counts), counts < 0)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *[pa.array(np.diff(t)) for t in totals]], names=names)
                start += len(texts)

    names = [id_col, "n_words", "n_tokens", "n_unknown"]
    schema = f"`{id_col}` {type_of(df, id_col)}, n_words long, n_tokens long, n_unknown long"
    return df.select(id_col, text_col).mapInArrow(work, schema)
