"""Operator 1: SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of the
piece they would make, then by position, and merges from the top until no pair
makes a piece. No piece of such a vocabulary goes from a word into the next
space (this is checked when the vocabulary is loaded), so a text falls apart
into units, each a run of spaces with the word behind it, and each different unit
of an Arrow batch is worked out once. The agendas of all these units stand side
by side in arrays and lose their top pair together, a round at a time; a very
long unit has a heap of its own. The same units are encoded by the
``sentencepiece`` library and must agree, so every unit of every text is held
against the library.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to the empty text; equal texts have equal results, each row its own;
texts may have any length; an empty table gives an empty table; columns other
than the id and the text are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, compress, pairwise
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from roadbook.llm.common import ship, type_of

SPACE = "▁"
_UNIT = re.compile(" +[^ ]*")
# Longer units have a heap each: rounds over arrays would be as many as their merges.
HEAP_LENGTH = 96
CHUNK_CHARS = 4_000_000
# Ids that are Python numbers at a time, for the library to decode.
DECODED = 200_000
# Worked-out units that a worker remembers; past that it keeps those of the chunk at hand.
REMEMBERED = 1_000_000
# Units a text, where the library checks them: few calls, short texts.
CHECKED_TOGETHER = 64
NONE = np.int32(2**31 - 1)


class PairTable:
    """(left symbol, right symbol) to (rank of the merge, symbol made), looked up in arrays."""

    SLOTS = 19

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        self.slots = max(self.SLOTS, int(4 * len(pairs)).bit_length())
        size = 1 << self.slots
        self.keys = np.full(size, -1, np.int64)
        self.ranks, self.made = np.full(size, NONE, np.int32), np.zeros(size, np.int32)
        slots = self._slot(keys)
        while len(keys):
            slots, order = np.unique(slots, return_index=True)  # one key a slot and round
            free = self.keys[slots] == -1
            put = order[free]
            self.keys[slots[free]] = keys[put]
            self.ranks[slots[free]], self.made[slots[free]] = values[put].T
            rest = np.setdiff1d(np.arange(len(keys)), put)
            keys, values = keys[rest], values[rest]
            slots = self._slot(keys)
            for _ in range(size):  # the first slot that is free, step by step
                taken = self.keys[slots] != -1
                if not taken.any():
                    break
                slots = np.where(taken, (slots + 1) & (size - 1), slots)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.slots)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        found = self.keys[slots]
        astray = np.flatnonzero((found != keys) & (found != -1))
        while len(astray):
            slots[astray] = (slots[astray] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[astray]]
            astray = astray[(found != keys[astray]) & (found != -1)]
        return self.ranks[slots], self.made[slots]


class PieceCodec:
    """One vocabulary: units to ids by the agenda, ids to text by the library."""

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        if lib.normalize(" a  b\tﬁ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b\tﬁ":
            raise ValueError("only vocabularies that leave texts as they are, behind one added space, are supported")
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes = [0] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not lib.is_control(i) and not lib.is_unknown(i):
                self.pieces[piece] = (-lib.get_score(i), i)
        if not all(self.bytes):
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        self.separable = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        self.size = lib.get_piece_size()
        scores = sorted({cost for cost, _ in self.pieces.values()})
        rank = dict(zip(scores, range(len(scores))))
        self.table = PairTable({
            (self._symbol(piece[:i]), self._symbol(piece[i:])): (rank[cost], number)
            for piece, (cost, number) in self.pieces.items() for i in range(1, len(piece))
            if (i == 1 or piece[:i] in self.pieces) and (i == len(piece) - 1 or piece[i:] in self.pieces)})
        self._remember(pa.array([], pa.string()), np.zeros(0), np.zeros(0))
        # a symbol for each character: its piece, or a number above all pieces
        self.characters = np.arange(0x110000, dtype=np.int32) + self.size
        for piece, (_, number) in self.pieces.items():
            if len(piece) == 1:
                self.characters[ord(piece)] = number

    def _symbol(self, piece: str) -> int:
        return self.pieces[piece][1] if piece in self.pieces else self.size + ord(piece)

    def units(self, text: str) -> list[str]:
        """The text's units without their first space, which may be the added one."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        return [u[1:] for u in _UNIT.findall(" " + text)] if self.separable else [text]

    def split(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """All units, and where each text's begin and how many it has: texts with runs of spaces come last."""
        odd = np.ones(len(texts), bool)
        if self.separable:
            odd = pc.match_substring_regex(texts, f"^$|^ | $|  |{SPACE}").to_numpy(zero_copy_only=False)
        plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        strange = [self.units(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        counts = np.zeros(len(texts), np.int64)
        counts[~odd] = pc.list_value_length(plain).to_numpy()
        counts[odd] = [len(x) for x in strange]
        starts = np.zeros(len(texts), np.int64)
        order = np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))
        starts[order] = np.cumsum(counts[order]) - counts[order]
        units = plain.flatten()
        if odd.any():
            units = pa.concat_arrays([units, pa.array(list(chain.from_iterable(strange)), pa.string())])
        return units, starts, counts

    def merge(self, unit: str) -> tuple[int, ...]:
        """The ids of one unit: pop the best pair, merge it, offer its new neighbours."""
        symbols: list[str] = list(SPACE + unit.replace(" ", SPACE))
        n, pieces = len(symbols), self.pieces
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(made[0], i, symbols[i] + symbols[i + 1])
                  for i in range(n - 1) if (made := pieces.get(symbols[i] + symbols[i + 1]))]
        heapq.heapify(agenda)
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left]
            if right >= n or not symbols[left] or symbols[left] + symbols[right] != piece:
                continue  # one of the two has been merged away since
            symbols[left], symbols[right] = piece, ""
            after[left] = behind = after[right]
            if behind < n:
                before[behind] = left
                if made := pieces.get(piece + symbols[behind]):
                    heapq.heappush(agenda, (made[0], left, piece + symbols[behind]))
            if (ahead := before[left]) >= 0 and (made := pieces.get(symbols[ahead] + piece)):
                heapq.heappush(agenda, (made[0], ahead, symbols[ahead] + piece))
        ids: list[int] = []
        for symbol in filter(None, symbols):
            if known := pieces.get(symbol):
                ids.append(known[1])
            else:
                ids.extend(self.bytes[b] for b in symbol.encode())
        return tuple(ids)

    def merge_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of many units: each round pops the best pair of every agenda that has one.

        Returns them one unit behind the other, and how many each unit has.
        """
        whole = "".join([SPACE + u for u in units]).replace(" ", SPACE)
        lengths = np.array([len(u) + 1 for u in units], np.int64)
        symbols, of = self.characters[np.frombuffer(whole.encode("utf-32-le"), np.uint32)], np.arange(len(units))
        owner = np.repeat(of, lengths)
        ranks, made = np.full(len(symbols), NONE, np.int32), np.zeros(len(symbols), np.int32)
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[pairs], made[pairs] = self.table.find(symbols[pairs], symbols[pairs + 1])
        ended_of, ended_lengths, ended_symbols = [], [], []
        while len(of):
            best = np.minimum.reduceat(ranks, np.cumsum(lengths) - lengths)
            if (ended := best == NONE).any():
                leaves = np.repeat(ended, lengths)
                ended_of.append(of[ended])
                ended_lengths.append(lengths[ended])
                ended_symbols.append(symbols[leaves])
                symbols, ranks, made = symbols[~leaves], ranks[~leaves], made[~leaves]
                of, lengths, best = of[~ended], lengths[~ended], best[~ended]
                if not len(of):
                    break
            owner = np.repeat(np.arange(len(of)), lengths)
            top = np.flatnonzero(ranks == best[owner])
            top = top[np.concatenate(([True], owner[top[1:]] != owner[top[:-1]]))]
            symbols[top] = made[top]
            stays = np.ones(len(symbols), bool)
            stays[top + 1] = False
            symbols, ranks, made, owner = symbols[stays], ranks[stays], made[stays], owner[stays]
            lengths = lengths - 1
            top = top - np.arange(len(top))
            ranks[top] = NONE
            right = top[owner[np.minimum(top + 1, len(owner) - 1)] == owner[top]]
            right = right[right + 1 < len(owner)]
            ranks[right], made[right] = self.table.find(symbols[right], symbols[right + 1])
            left = top[(top > 0) & (owner[top - 1] == owner[top])] - 1
            ranks[left], made[left] = self.table.find(symbols[left], symbols[left + 1])
        of, lengths = np.concatenate(ended_of), np.concatenate(ended_lengths)
        order = np.argsort(of)
        return np.concatenate(ended_symbols)[spans((np.cumsum(lengths) - lengths)[order], lengths[order])], lengths[order]

    def work_out(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different units, one behind the other, and how many each has."""
        if not units:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        long = [i for i, u in enumerate(units) if len(u) >= HEAP_LENGTH]
        flat, lengths = self.merge_all(["" if len(u) >= HEAP_LENGTH else u for u in units] if long else units)
        widths = np.ones(len(flat), np.int64)
        strange = np.flatnonzero(flat >= self.size)  # characters without a piece are spelt in bytes
        codes, which = np.unique(flat[strange] - self.size, return_inverse=True)
        spelt = [[self.bytes[b] for b in chr(c).encode()] for c in codes.tolist()]
        widths[strange] = np.array([len(x) for x in spelt], np.int64)[which]
        out, first = np.repeat(flat, widths), np.cumsum(widths) - widths
        for c, ids in enumerate(spelt):
            for j, number in enumerate(ids):
                out[first[strange[which == c]] + j] = number
        lengths = np.add.reduceat(widths, np.cumsum(lengths) - lengths)
        if long:
            rows = np.split(out, np.cumsum(lengths)[:-1])
            for i in long:
                rows[i] = np.array(self.merge(units[i]), np.int32)
            out, lengths = np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
        self.compare(units, out, lengths)
        return out, lengths

    def compare(self, units: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Raise if the library encodes any unit otherwise."""
        ends = [u == "" or u[-1] == " " for u in units]  # a space behind these would join them
        plain = list(compress(units, map(not_, ends)))
        texts = [" ".join(plain[i: i + CHECKED_TOGETHER]) for i in range(0, len(plain), CHECKED_TOGETHER)]
        # the library sees an empty unit as an empty text and adds no space: nothing to merge there
        texts += [u for u in compress(units, ends) if u]
        theirs = self.library.encode(texts, num_threads=1)
        ends = np.array(ends)
        ours = [ids[np.repeat(~ends, lengths)], ids[np.repeat(ends & np.array([u != "" for u in units]), lengths)]]
        if not np.array_equal(np.concatenate(ours), np.fromiter(chain.from_iterable(theirs), np.int32)):
            raise RuntimeError("the agenda and the library differ")

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and how many each text has."""
        units, starts, counts = self.split(texts)
        if not len(units):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = units.dictionary_encode()
        at = self.recall(coded.dictionary)
        which = at[coded.indices.to_numpy()]
        width = self.lengths[which]
        upto = np.concatenate(([0], np.cumsum(width)))
        first, lengths = upto[starts], upto[starts + counts] - upto[starts]
        ids = self.ids[spans(self.starts[which], width)]
        if (np.diff(starts) < 0).any():  # back into the texts' order
            ids = ids[spans(first, lengths)]
        return ids, lengths

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts that the library makes of runs of ids; few of them at a time are Python numbers."""
        texts: list[str] = []
        start = 0
        while start < len(offsets) - 1:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + DECODED, "right")) - 1)
            rows = [ids[a:b].tolist() for a, b in pairwise(offsets[start: end + 1].tolist())]
            texts += self.library.decode(rows, num_threads=1)
            start = end
        return texts

    def recall(self, units: pa.StringArray) -> np.ndarray:
        """The places of different units among those worked out; the new ones are added."""
        at = pc.index_in(units, self.known)
        new = units.filter(pc.is_null(at))
        if len(self.known) + len(new) > REMEMBERED:
            here = pc.drop_null(at).to_numpy()
            self._remember(units.filter(pc.is_valid(at)), self.ids[spans(self.starts[here], self.lengths[here])],
                           self.lengths[here])
            at = pc.index_in(units, self.known)
        places = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        places[pc.is_null(at).to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
        ids, lengths = self.work_out(new.to_pylist())
        self._remember(pa.concat_arrays([self.known, new]), np.concatenate((self.ids, ids)),
                       np.concatenate((self.lengths, lengths)))
        return places

    def _remember(self, units: pa.StringArray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known, self.ids, self.lengths = units, ids.astype(np.int32), lengths.astype(np.int32)
        self.starts = (np.cumsum(lengths) - lengths).astype(np.int32)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs with these starts and lengths, one run behind the other."""
    ends = np.cumsum(lengths, dtype=np.int32)
    return np.repeat(starts.astype(np.int32) - (ends - lengths.astype(np.int32)), lengths) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)


_codecs: dict[int, PieceCodec] = {}


def codec(model: bytes) -> PieceCodec:
    """One codec for each vocabulary and worker, kept from task to task."""
    key = hash(model)
    if key not in _codecs:
        _codecs[key] = PieceCodec(model)
    return _codecs[key]


def chunks(texts: pa.StringArray, most: int = CHUNK_CHARS) -> Iterator[pa.StringArray]:
    """Slices of a batch that hold about ``most`` bytes of text or one text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(start, end - start)
        start = end


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_decode(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                  decode: bool = True) -> DataFrame:
    """``id_col``, ``ids`` array<int> and, if asked for, ``decoded``: the ids turned back into text."""
    ship(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            start = 0
            for texts in chunks(pc.fill_null(batch.column(1).cast(pa.string()), "")):
                ids, lengths = own.encode(texts)
                offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                out = [batch.column(0).slice(start, len(texts)), pa.ListArray.from_arrays(offsets, ids)]
                if decode:
                    out.append(pa.array(own.decode(ids, offsets), pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=names)
                start += len(texts)

    names = [id_col, "ids", "decoded"][: 3 if decode else 2]
    schema = f"`{id_col}` {type_of(df, id_col)}, ids array<int>" + ", decoded string" * decode
    return df.select(id_col, text_col).mapInArrow(work, schema)
