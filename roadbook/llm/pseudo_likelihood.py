"""Operator 4: language-model scores by masked pseudo-likelihood.

A small network predicts each token from the ``SIDE`` tokens before and the
``SIDE`` behind it, the token itself masked; a document's score is the sum of the
log-probabilities of its tokens so conditioned. Tokens are words. The network
knows the commonest ones of the corpus, by exact counts over all documents, and
for the others classes by their endings. ``score_words`` scores the words
themselves: a word of a class adds log P(word | class) by the counts of all
words, so the vocabulary is every word of the corpus. The counts of frequent
words travel with the tasks, those of the others are joined by the word.

P(word | class) is n(word) / (n(class) + 1): whatever words of a class were never
counted share the place of one word counted once.

The network is an embedding of the neighbours, one hidden layer and a softmax,
in numpy. Every document takes part in its training: documents are dealt to
``ROUNDS`` rounds by the hash of their text; in a round each task starts from the
common weights and goes over its share of the round's documents once, and the
tasks' weights are averaged, each counting as many steps as it made. The average
is taken by Spark in whole numbers, position by position, so neither the driver
nor a task holds more than one set of weights, whatever the corpus, and the sum
does not depend on the tasks' order.

Defined results: null and empty texts have no tokens, score 0 and no mean; texts
of any length are scored whole; repeated rows are rows of their own, equal up to rounding; a corpus
without words leaves the network untrained; an empty table gives an empty table;
columns other than id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship, type_of
from roadbook.llm.sentencepiece_codec import chunks

COMMON, CLASSES = 96, 32
SIDE, EMBEDDED, HIDDEN = 2, 12, 32
ROUNDS, BATCH, RATE = 2, 1024, 0.5
CHUNK_CHARS = 4_000_000
# Weights are averaged as multiples of this.
UNIT = 2.0**-24
# Tokens scored at a time: their logits stay in the processor's cache.
BLOCK = 1024
# Logits that cannot reach this are not shifted before they are exponents: 128 of its exponential fit a float32.
LARGEST_LOGIT = 80.0
# Words whose counts travel with the tasks, at most.
CARRIED = 65_536
# Logarithms that are joined are summed as multiples of this: no order of tasks shows.
LOG_UNIT = 2.0**-30


@dataclass
class Network:
    """Weights; token number ``size`` stands for what lies outside the document."""

    embedding: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    @classmethod
    def shapes(cls, size: int) -> list[tuple[int, ...]]:
        return [(size + 1, EMBEDDED), (2 * SIDE, EMBEDDED, HIDDEN), (HIDDEN,), (HIDDEN, size), (size,)]

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Small random weights; without neighbours to go by, the tokens' frequencies."""
        rng, shapes = np.random.default_rng(0), cls.shapes(len(counts))
        drawn = [rng.normal(0, 0.5 if len(s) == 2 and s[1] == EMBEDDED else 0.2, s) for s in shapes]
        drawn[2][:] = 0
        share = (counts + 1) / (counts.sum() + len(counts))
        drawn[4] = np.log(share)
        return cls(*[d.astype(np.float32) for d in drawn])

    @classmethod
    def from_flat(cls, flat: np.ndarray, size: int) -> Network:
        parts, at = [], 0
        for shape in cls.shapes(size):
            n = int(np.prod(shape))
            parts.append(flat[at: at + n].reshape(shape).astype(np.float32))
            at += n
        return cls(*parts)

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.inner, self.inner_bias, self.outer, self.outer_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def _exponents(self, hidden: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens' logits, all exponentials and their sums; shifted first where some could grow too large."""
        logits = hidden @ self.outer
        logits += self.outer_bias
        # hidden units lie between -1 and 1, so the weights bound the logits
        if not (np.abs(self.outer).sum(axis=0) + np.abs(self.outer_bias)).max() < LARGEST_LOGIT:
            logits -= logits.max(axis=1, keepdims=True)
        chosen = logits[np.arange(len(tokens)), tokens]
        powers = np.exp(logits, out=logits)  # in place: a second array of this size costs more than the exponentials
        return chosen, powers, powers @ np.ones(powers.shape[1], powers.dtype)

    def _tables(self) -> np.ndarray:
        """Each neighbour's way into the hidden layer, worked out once for each place and token number."""
        return np.matmul(self.embedding, self.inner)

    def _hidden(self, tables: np.ndarray, around: np.ndarray) -> np.ndarray:
        inner = tables[0].take(around[:, 0], axis=0)
        for k in range(1, 2 * SIDE):
            inner += tables[k].take(around[:, k], axis=0)
        inner += self.inner_bias
        return np.tanh(inner, out=inner)

    def log_probabilities(self, around: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Of each token given the 2 * SIDE tokens around it."""
        tables = self._tables()
        out = np.empty(len(tokens), np.float64)
        for start in range(0, len(tokens), BLOCK):
            some = around[start: start + BLOCK]
            chosen, _, sums = self._exponents(self._hidden(tables, some), tokens[start: start + BLOCK])
            out[start: start + BLOCK] = chosen - np.log(sums)
        return out

    def learn(self, around: np.ndarray, tokens: np.ndarray, rate: float) -> None:
        """One gradient step on a batch."""
        n = len(tokens)
        hidden = self._hidden(self._tables(), around)
        _, error, sums = self._exponents(hidden, tokens)
        error *= (1 / (n * sums))[:, None]
        error[np.arange(n), tokens] -= 1 / n
        below = error @ self.outer.T
        below *= 1 - hidden * hidden
        self.outer -= rate * (hidden.T @ error)
        self.outer_bias -= rate * (np.ones(n, error.dtype) @ error)
        # what reaches each place and token number, and from there the weights before it
        back = np.zeros((2 * SIDE, len(self.embedding), HIDDEN), below.dtype)
        for k in range(2 * SIDE):
            order = np.argsort(around[:, k], kind="stable")
            sorted_ = around[order, k]
            first = np.flatnonzero(np.diff(sorted_, prepend=-1))
            back[k, sorted_[first]] = np.add.reduceat(below.take(order, axis=0), first, axis=0)
        step = np.matmul(back, self.inner.transpose(0, 2, 1)).sum(axis=0)
        self.inner -= rate * np.matmul(self.embedding.T, back)
        self.inner_bias -= rate * back[0].sum(axis=0)  # each row of the batch is in it once
        self.embedding -= rate * step


class Tokens:
    """Words to token numbers: common words one each, others by their ending."""

    def __init__(self, common: list[str]):
        self.common, self.numbers = pa.array(common, pa.string()), len(common)
        self.size = len(common) + CLASSES

    def split(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The token numbers of all texts one behind the other, and how many each has."""
        numbers, coded, lengths = self.split_coded(texts)
        return numbers[coded.indices.to_numpy()], lengths

    def split_coded(self, texts: pa.StringArray) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
        """The token number of each different word, the words so coded, and how many each text has."""
        lists = words_of(texts)
        coded = lists.flatten().dictionary_encode()
        at = pc.index_in(coded.dictionary, self.common)
        numbers = pc.fill_null(at, 0).to_numpy().astype(np.int32)
        rare = pc.is_null(at).to_numpy(zero_copy_only=False)
        endings = [zlib.crc32(w[-3:].encode()) % CLASSES for w in coded.dictionary.filter(pc.is_null(at)).to_pylist()]
        numbers[rare] = self.numbers + np.array(endings, np.int32)
        return numbers, coded, pc.list_value_length(lists).to_numpy().astype(np.int64)

    def around(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each token the numbers of its neighbours; ``size`` beyond the text's ends."""
        padded = np.full(len(tokens) + SIDE * (len(lengths) + 1), self.size, np.int32)
        places = np.arange(len(tokens)) + SIDE * (1 + np.repeat(np.arange(len(lengths)), lengths))
        padded[places] = tokens
        return np.stack([padded[places + d] for d in range(-SIDE, SIDE + 1) if d], axis=1)


def words_of(texts: pa.StringArray) -> pa.ListArray:
    """Small-letter words of each text; white space alone divides them."""
    trimmed = pc.utf8_lower(pc.ascii_trim_whitespace(texts))
    lists = pc.ascii_split_whitespace(trimmed)
    empty = pc.equal(trimmed, "")
    if pc.any(empty).as_py():
        lists = pa.array([[] if e else x for e, x in zip(empty.to_pylist(), lists.to_pylist())], pa.list_(pa.string()))
    return lists


def count_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n`` over all documents; counted within batches, then by Spark."""
    ship(df.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(pc.fill_null(batch.column(0).cast(pa.string()), ""), 4 * CHUNK_CHARS):
                counted = words_of(texts).flatten().value_counts()
                yield pa.RecordBatch.from_arrays(counted.flatten(), names=["word", "n"])

    counted = df.select(text_col).mapInArrow(work, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def train(df: DataFrame, text_col: str = "text", common: int = COMMON, rounds: int = ROUNDS,
          counted: DataFrame | None = None) -> tuple[Tokens, Network]:
    """Token numbers and a network fitted to every document of the corpus; ``counted``: its words, if counted before."""
    ship(df.sparkSession)
    scratch, own = Scratch(df.sparkSession, "words"), counted is None
    if own:
        counted = scratch.keep(count_words(df, text_col))
    top = counted.orderBy(F.desc("n"), "word").limit(common).collect()
    others = (counted.agg(F.sum("n")).first()[0] or 0) - sum(r.n for r in top)
    if own:
        scratch.drop(counted)
    tokens = Tokens([r.word for r in top])
    network = Network.start(np.array([r.n for r in top] + [others / CLASSES] * CLASSES, np.float64))
    for number in range(rounds):
        share = df.select(text_col).where(F.pmod(F.xxhash64(text_col), F.lit(rounds)) == number)
        network = _round(share, tokens, network, RATE / (number + 1))
    return tokens, network


def _round(share: DataFrame, tokens: Tokens, network: Network, rate: float) -> Network:
    start = network.flat()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, steps = Network.from_flat(start, tokens.size), 0
        for batch in batches:
            for texts in chunks(pc.fill_null(batch.column(0).cast(pa.string()), ""), CHUNK_CHARS):
                numbers, lengths = tokens.split(texts)
                around = tokens.around(numbers, lengths)
                order = np.random.default_rng(len(numbers)).permutation(len(numbers))
                for at in range(0, len(order), BATCH):
                    some = order[at: at + BATCH]
                    # smaller batches make smaller steps, and all steps become smaller with time
                    pace = rate * len(some) / BATCH / (1 + steps / 2000)
                    own.learn(around[some], numbers[some], pace)
                    steps += 1
        if steps:
            moved = np.rint((own.flat() - start) / UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(moved), dtype=np.int32)), pa.array(moved),
                                              pa.array(np.full(len(moved), steps))], names=["place", "moved", "steps"])

    whole = lambda c: F.col(c).cast("decimal(19,0)")
    moved = (share.mapInArrow(work, "place int, moved long, steps long")
             .groupBy("place").agg((F.sum(whole("moved") * F.col("steps").cast("decimal(10,0)")) / F.sum("steps")).cast("double").alias("moved"))
             .collect())
    flat = start.astype(np.float64)
    for r in moved:
        flat[r.place] += r.moved * UNIT
    return Network.from_flat(flat, tokens.size)


def score(df: DataFrame, tokens: Tokens, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, log_likelihood, mean``: sums over all tokens of each document, a rare word scored as its class."""
    ship(df.sparkSession)
    flat = network.flat()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.from_flat(flat, tokens.size)
        for batch in batches:
            start = 0
            for texts in chunks(pc.fill_null(batch.column(1).cast(pa.string()), ""), CHUNK_CHARS):
                numbers, lengths = tokens.split(texts)
                found = own.log_probabilities(tokens.around(numbers, lengths), numbers)
                of = np.repeat(np.arange(len(lengths)), lengths)
                sums = np.bincount(of, found, len(lengths)).astype(np.float64)
                mean = pa.array(sums / np.maximum(lengths, 1), mask=lengths == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(lengths), pa.array(sums), mean],
                    names=[id_col, "n_tokens", "log_likelihood", "mean"])
                start += len(texts)

    schema = f"`{id_col}` {type_of(df, id_col)}, n_tokens long, log_likelihood double, mean double"
    return df.select(id_col, text_col).mapInArrow(work, schema)


def class_totals(counted: DataFrame, tokens: Tokens) -> np.ndarray:
    """How many words of the corpus each class stands for."""
    ending = F.crc32(F.expr("right(word, 3)").cast("binary")) % CLASSES
    rare = counted.where(~F.col("word").isin(tokens.common.to_pylist())) if tokens.numbers else counted
    totals = np.zeros(CLASSES)
    for r in rare.groupBy(ending.alias("ending")).agg(F.sum("n").alias("n")).collect():
        totals[r.ending] = r.n
    return totals


def frequent(counted: DataFrame) -> tuple[int, pa.Table]:
    """The least power of two that at most ``CARRIED`` words reach, and those words with their counts."""
    power = F.length(F.bin("n")) - 1
    least, words = 1, 0
    for r in counted.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():
        words += r["count"]
        if words > CARRIED:
            least = 2 ** (r.power + 1)
            break
    return least, counted.where(F.col("n") >= least).select("word", "n").toArrow()


def score_words(df: DataFrame, tokens: Tokens, network: Network, counted: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """As ``score``, each word scored as itself; ``counted``: ``word, n`` of the corpus, stored."""
    spark = df.sparkSession
    ship(spark)
    flat = network.flat()
    classes = np.log(np.concatenate((np.ones(tokens.numbers), class_totals(counted, tokens) + 1)))
    least, carried = frequent(counted)
    known = carried.column("word").combine_chunks().cast(pa.string())
    logs = np.append(np.log(carried.column("n").to_numpy().astype(np.float64)), 0.0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, row = Network.from_flat(flat, tokens.size), TaskContext.get().partitionId() << 33
        for batch in batches:
            start = 0
            for texts in chunks(pc.fill_null(batch.column(1).cast(pa.string()), ""), CHUNK_CHARS):
                by_word, coded, lengths = tokens.split_coded(texts)
                at, indices = pc.index_in(coded.dictionary, known), coded.indices.to_numpy()
                numbers = by_word[indices]
                found = own.log_probabilities(tokens.around(numbers, lengths), numbers)
                rare = by_word >= tokens.numbers
                place = pc.fill_null(at, len(known)).to_numpy()
                found += np.where(rare, logs[place], 0.0)[indices] - classes[numbers]
                of = np.repeat(np.arange(len(lengths)), lengths)
                sums = np.bincount(of, found, len(lengths)).astype(np.float64)
                n, none = len(texts), pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), batch.column(0).slice(start, n), pa.array(lengths), pa.array(sums),
                     none(n, pa.string()), none(n, pa.list_(pa.int32()))], names=names)
                # the words whose counts are elsewhere, each with the texts that have it
                away = rare & (place == len(known))
                if away.any():
                    here = np.flatnonzero(away[indices])
                    here = here[np.argsort(indices[here], kind="stable")]
                    ends = np.cumsum(np.bincount(indices[here], minlength=len(away))[away])
                    texts_of = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(of[here].astype(np.int32)))
                    m = len(ends)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, row)), none(m, batch.column(0).type), none(m, pa.int64()), none(m, pa.float64()),
                         coded.dictionary.filter(pa.array(away)), texts_of], names=names)
                start, row = start + n, row + n

    names = ["row", "id", "n_tokens", "sums", "word", "texts"]
    schema = f"row long, id {type_of(df, id_col)}, n_tokens long, sums double, word string, texts array<int>"
    stored = Scratch(spark, "scores").keep(df.select(id_col, text_col).mapInArrow(work, schema))
    # a word counted once adds log 1, like one never counted
    others = counted.where((F.col("n") > 1) & (F.col("n") < least)).select(
        "word", F.round(F.log("n") / LOG_UNIT).cast("long").alias("log"))
    joined = (stored.where("word is not null").select("row", "word", "texts").join(others, "word")
              .select("row", "log", F.explode("texts").alias("text"))
              .groupBy((F.col("row") + F.col("text")).alias("row")).agg(F.sum("log").alias("logs")))
    total = F.col("sums") + F.coalesce(F.col("logs") * LOG_UNIT, F.lit(0.0))
    return (stored.where("word is null").select("row", "id", "n_tokens", "sums").join(joined, "row", "left")
            .select(F.col("id").alias(id_col), "n_tokens", total.alias("log_likelihood"),
                    F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean")))


def score_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document scored by a network and by the counts of words that the same documents give."""
    counted = Scratch(df.sparkSession, "words").keep(count_words(df, text_col))
    return score_words(df, *train(df, text_col, counted=counted), counted, id_col, text_col)
