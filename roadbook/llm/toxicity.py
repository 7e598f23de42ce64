"""Operator 9: toxicity by a chain of linear classifiers.

The categories of the labels are predicted one after the other. A later model
sees, beside the text's features, the log-odds that the earlier models gave it;
for fitting these come from out-of-fold predictions, so that a later model never
learns from a probability whose model had seen that row.

Features are words and word beginnings that go with a category, as Spark counts
them over the labelled sample, and a few shares (capitals, digits, marks,
different words). The sample is bounded: the ``SAMPLE`` labelled documents whose
hashed id is smallest. Fitting is on the driver, over at most ``SAMPLE`` rows of
``FEATURES`` columns; everything that reads text runs in tasks, and every
document is scored on its whole text.

Defined results: a null or empty text has no features and is scored by the
models' offsets; labels that are null, or that name no document, are left out,
of an id's several labels the largest counts and of its several texts the one
with the smallest hash; a category with one kind of label has that constant as
its probability, and so has every category without any label (then 0); repeated
rows are rows of their own; an empty table gives an empty table; columns other
than id, text and the categories are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import Scratch, ship, type_of

SAMPLE = 16_000
FEATURES = 1_024
LEAST_DOCUMENTS = 5
# Chi-square of a feature with a category below which it is chance, among some hundred thousand candidates.
LEAST_CHI2 = 45.0
FOLDS = 5
BEGINNINGS = (4, 5)
STEPS, RIDGE = 200, 1e-4
_WORD = re.compile(r"[^\W_]+")


def features(text: str) -> set[str]:
    """Different words, small letters, and the beginnings of the longer ones (marked by a dash)."""
    found = set(_WORD.findall(text.lower()))
    return found.union(*[{w[:n] + "-" for w in found if len(w) > n} for n in BEGINNINGS])


def shares(text: str, words: int, different: int) -> list[float]:
    n = max(1, len(text))
    letters = sum(map(len, _WORD.findall(text)))
    capitals = sum(1 for c in text if c.isupper()) if not text.islower() else 0
    digits = sum(map(text.count, "0123456789"))
    return [np.log1p(words) / 10, capitals / n, digits / n, 1 - letters / n, different / max(1, words)]


SHARES = 5


def describe(texts: Sequence[str | None], index: dict[str, int]) -> tuple[list[list[int]], np.ndarray]:
    """The known features of each text, as columns, and its shares."""
    known, columns, dense = index.keys(), [], np.zeros((len(texts), SHARES))
    for i, text in enumerate(texts):
        text = text or ""
        words = _WORD.findall(text.lower())
        different = set(words)
        found = (different & known).union(
            *[{b for w in different if len(w) > n and (b := w[:n] + "-") in index} for n in BEGINNINGS])
        columns.append(sorted(index[f] for f in found))
        dense[i] = shares(text, len(words), len(different))
    return columns, dense


def matrix(columns: pa.ListArray, dense: np.ndarray, width: int, categories: int) -> np.ndarray:
    """A row for each text: 0/1 for words, then shares, then room for the categories' log-odds."""
    x = np.zeros((len(columns), width + SHARES + categories), np.float32)
    lengths = pc.list_value_length(columns).to_numpy()
    x[np.repeat(np.arange(len(columns)), lengths), columns.flatten().to_numpy()] = 1
    x[:, width: width + SHARES] = dense
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)) / 10


def fit(x: np.ndarray, y: np.ndarray, width: int, used: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps, over the rows ``used``.

    The first ``width`` columns, the words, are scaled by how their odds differ
    between the two kinds of rows, so that the ridge holds back those that hardly
    do. Scales and left-out rows are factors, so the one matrix is never copied.
    """
    used = np.ones(len(y), np.float32) if used is None else used.astype(np.float32)
    n, marked = float(used.sum()), float(used @ y)
    if marked in (0.0, n):
        return np.zeros(x.shape[1]), 30.0 if marked else -30.0
    both, of_marked = used @ x[:, :width], (used * y).astype(np.float32) @ x[:, :width]
    scale = np.ones(x.shape[1], np.float32)
    scale[:width] = np.abs(np.log((of_marked + 0.5) / (marked + 1)) - np.log((both - of_marked + 0.5) / (n - marked + 1)))
    w, b = np.zeros(x.shape[1], np.float32), float(np.log(marked / (n - marked)))
    # curvature: a quarter of the largest eigenvalue of x'x/n, by power steps
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v = scale * (x.T @ (used * (x @ (scale * v))))
        size = float(np.linalg.norm(v))
        v /= size or 1.0
    step = 1 / (size / n / 4 + 0.25 + RIDGE)
    past, past_b = w, b
    for t in range(1, STEPS + 1):
        speed = (t - 1) / (t + 2)
        at, at_b = w + speed * (w - past), b + speed * (b - past_b)
        error = (used * (sigmoid(x @ (scale * at) + at_b) - y)).astype(np.float32)
        past, past_b = w, b
        w = at - step * (scale * (x.T @ error) / np.float32(n) + RIDGE * at)
        b = at_b - step * float(error.sum()) / n
    return (w * scale).astype(np.float64), b


@dataclass
class Chain:
    """Fitted models in the order of their categories."""

    categories: list[str]
    index: dict[str, int]
    weights: list[np.ndarray]
    offsets: list[float]
    thresholds: list[float]

    def predict(self, texts: Sequence[str | None]) -> np.ndarray:
        """One column of probabilities for each category."""
        columns, dense = describe(texts, self.index)
        width = len(self.index)
        out = np.zeros((len(texts), len(self.categories)))
        for k, (w, b) in enumerate(zip(self.weights, self.offsets)):
            sums = np.array([w[c].sum() for c in columns]) if columns else np.zeros(0)
            earlier = logit(out[:, :k]) @ w[width + SHARES:] if k else 0.0
            out[:, k] = sigmoid(sums + dense @ w[width:width + SHARES] + earlier + b)
        return out


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, width: int) -> tuple[list, list, np.ndarray]:
    """Weights and offsets of each category, and the out-of-fold probabilities.

    The last columns of ``x``, one a category, are filled in as the chain goes.
    """
    weights, offsets, held = [], [], np.zeros(labels.shape)
    for k in range(labels.shape[1]):
        seen = x[:, : width + SHARES + k]
        for f in range(FOLDS):
            w, b = fit(seen, labels[:, k], width, fold != f)
            held[fold == f, k] = sigmoid(seen[fold == f] @ w.astype(np.float32) + b)
        w, b = fit(seen, labels[:, k], width)
        weights.append(w)
        offsets.append(b)
        x[:, width + SHARES + k] = logit(held[:, k])
    return weights, offsets, held


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where out-of-fold probabilities tell the labels apart best (F1), in the middle of the best gap."""
    order = np.argsort(-p, kind="stable")
    ranked, hits = p[order], np.cumsum(y[order])
    ends = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True)) if len(p) else np.zeros(0, int)
    if not len(p) or not hits[-1]:
        return 0.5
    f1 = 2 * hits[ends] / (ends + 1 + hits[-1])
    best = ends[int(np.argmax(f1))]
    below = ranked[best + 1] if best + 1 < len(p) else 0.0
    return float(sigmoid(5 * (logit(ranked[best]) + logit(below))))


def labelled_sample(df: DataFrame, labels: DataFrame, categories: dict[str, F.Column], id_col: str, text_col: str,
                    sample: int) -> DataFrame:
    """``id, text`` and one 0/1 column for each category: at most ``sample`` rows."""
    marked = labels.select(F.col(id_col).alias("_id"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
    marked = marked.dropna().groupBy("_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))])
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    some = texts.join(marked, F.col("id") == F.col("_id"), "left_semi").select("id").distinct()
    some = some.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = texts.join(some.withColumnRenamed("id", "_of"), F.col("id") == F.col("_of")).drop("_of")
    one = Window.partitionBy("id").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").drop("_nth")
    return rows.join(marked, F.col("id") == F.col("_id")).drop("_id")


def choose_features(sample: DataFrame, n_categories: int, most: int) -> list[str]:
    """The words and beginnings that go most with a category, each category having an equal part."""
    ys = [f"y{i}" for i in range(n_categories)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, np.ndarray] = {}
            marks = np.column_stack([batch.column(i + 1).to_numpy() for i in range(n_categories)] + [np.ones(len(batch))])
            for text, mark in zip(batch.column(0).to_pylist(), marks):
                for f in features(text or ""):
                    counts[f] = counts.get(f, 0) + mark
            if counts:
                table = np.array(list(counts.values())).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(list(counts)), *[pa.array(c) for c in table.T]],
                                                 names=["feature", *ys, "n"])

    counted = (sample.select("text", *ys).mapInArrow(work, "feature string, " + ", ".join(f"{y} long" for y in ys) + ", n long")
               .groupBy("feature").agg(*[F.sum(c).alias(c) for c in [*ys, "n"]]).where(F.col("n") >= LEAST_DOCUMENTS))
    totals = sample.agg(F.count(F.lit(1)).alias("all"), *[F.sum(y).alias(f"{y}_all") for y in ys]).first()
    chosen: list[str] = []
    for y in ys:
        size, marked = totals["all"], totals[f"{y}_all"] or 0
        if not 0 < marked < size:
            continue
        a, n = F.col(y).cast("double"), F.col("n").cast("double")
        cross = a * float(size) - n * float(marked)  # association of a two by two table
        strength = cross * cross / (n * (float(size) - n + 1) * float(marked) * float(size - marked))
        chosen += [r.feature for r in counted.withColumn("strength", strength)
                   .where(F.col("strength") * float(size) >= LEAST_CHI2).orderBy(F.desc("strength"), "feature")
                   .limit(most // n_categories).select("feature").collect()]
    return list(dict.fromkeys(chosen))


def train(df: DataFrame, labels: DataFrame, categories: dict[str, F.Column], id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE, most: int = FEATURES) -> tuple[Chain, dict]:
    """The chain fitted on a bounded sample, with out-of-fold figures of how well each category is told."""
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "toxicity")
    rows = scratch.keep(labelled_sample(df, labels, categories, id_col, text_col, sample))
    index = {f: i for i, f in enumerate(choose_features(rows, len(categories), most))}
    ys = [f"y{i}" for i in range(len(categories))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, dense = describe(batch.column(0).to_pylist(), index)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns, pa.list_(pa.int32())), pa.array(list(dense), pa.list_(pa.float64())), *batch.columns[1:]],
                names=["columns", "dense", "place", *ys])

    schema = "columns array<int>, dense array<double>, place long, " + ", ".join(f"{y} int" for y in ys)
    got = (rows.select("text", F.xxhash64("id").alias("place"), *ys).mapInArrow(work, schema)
           .toArrow().sort_by("place"))
    places = got["place"].to_numpy()
    dense = got["dense"].combine_chunks().flatten().to_numpy().reshape(-1, SHARES)
    x = matrix(got["columns"].combine_chunks(), dense, len(index), len(ys))
    labels_01 = np.column_stack([got[y].to_numpy() for y in ys]).astype(np.float64)
    weights, offsets, held = fit_chain(x, labels_01, places % FOLDS, len(index))
    cuts = [threshold(held[:, k], labels_01[:, k]) for k in range(len(categories))]
    figures = {c: {"rows": len(places), "marked": int(labels_01[:, k].sum()), "threshold": cuts[k],
                   "caught": int(((held[:, k] >= cuts[k]) & (labels_01[:, k] == 1)).sum()),
                   "wrongly": int(((held[:, k] >= cuts[k]) & (labels_01[:, k] == 0)).sum())}
               for k, c in enumerate(categories)}
    scratch.drop(rows)
    return Chain(list(categories), index, weights, offsets, cuts), figures


def score(df: DataFrame, chain: Chain, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and for each category its probability ``p_`` and its verdict ``is_``.

    Underscores are put before these names where a kept column has one of them.
    """
    ship(df.sparkSession)
    keep = list(keep)
    columns = keep if text_col in keep else [*keep, text_col]
    at, names = columns.index(text_col), [f"{kind}_{c}" for c in chain.categories for kind in ("p", "is")]
    while set(names) & set(keep):
        names = [f"_{n}" for n in names]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = chain.predict(batch.column(at).to_pylist())
            out = [column for p, cut in zip(found.T, chain.thresholds) for column in (pa.array(p), pa.array(p >= cut))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[*keep, *names])

    schema = ", ".join([f"`{c}` {type_of(df, c)}" for c in keep]
                       + [f"`{n}` {kind}" for n, kind in zip(names, ("double", "boolean") * len(chain.categories))])
    return df.select(*columns).mapInArrow(work, schema)


# The labels name two kinds: text that is poor, and text that is toxic.
def categories() -> dict[str, F.Column]:
    """The chain's order: whether a text is poor says something about whether it is toxic."""
    return {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
