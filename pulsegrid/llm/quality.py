"""Document quality by positive-unlabelled learning.

Texts labelled good are trusted positives; all texts, taken without their labels, are the unlabelled sample.
A text is described by counts of its characters, words and lines (see ``FEATURES``); every description is cut
at quantiles of all documents, and an additive model over the cuts is fitted by minimising the non-negative
unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

with the logistic loss (where the part in brackets turns negative its gradient is reversed, so the model does
not fit the unlabelled sample by calling everything bad).  The class prior is estimated from the scores of a
first model of positives against all: the lowest ratio, over the scores above a level, of the share of all
texts to the share of positives.

Descriptions, cuts and prior cover all documents; the weights are fitted to at most ``fit_rows`` positives and
as many unlabelled rows, the first in hash order.  Labels, language, source and id never enter a score.

Rows: NULL and empty texts get a score like any other; repeated rows get equal scores; a document with
several labels is a positive if all say so; without any positive nothing can be learnt and every score is 1;
an empty table gives no rows.  Extra columns are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import TEXTS, Stored, binary_text, per_batch

FEATURES = (
    "length", "blank", "upper", "lower", "digit", "beyond_ascii", "stop_marks", "other_marks", "pipe", "exclaim",
    "symbol", "line_end", "entropy", "packed", "words", "word_length", "distinct_words", "repeats", "short_words",
    "marked_ends", "longest_word", "line_length", "distinct_lines", "upper_words",
)
_SCHEMA = ", ".join(f"{name} float" for name in FEATURES)
_QUANTILES = [i / 20 for i in range(1, 20)]
THRESHOLD = 0.7


def _range(*spans: str) -> np.ndarray:
    chosen = np.zeros(256)
    for span in spans:
        chosen[ord(span[0]):ord(span[-1]) + 1] = 1
    return chosen


_CLASSES = np.stack([
    _range(" ", "\t\r"), _range("AZ"), _range("az"), _range("09"), np.r_[np.zeros(128), np.ones(128)],
    _range(".", ",", ";", ":", "?"), _range("\"", "'", "(", ")", "-", "/", "[", "]"), _range("|"), _range("!"),
    _range("#", "$", "%", "&", "*", "+", "<", "=", ">", "@", "\\", "^", "_", "`", "{", "}", "~"), _range("\n"),
], axis=1)


def describe(text: bytes) -> tuple[float, ...]:
    """The features of a text in the order of FEATURES; rates lie between 0 and 1, sizes are logarithms."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = counts @ _CLASSES / max(1, n)
    present = counts[counts > 0] / max(1, n)
    tokens, lines = text.split(), text.split(b"\n")
    m = max(1, len(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.frombuffer(b"".join([t[-1:] for t in tokens]), np.uint8)
    letters = ((ends | 32) >= 97) & ((ends | 32) <= 122) | (ends >= 128) | ((ends >= 44) & (ends <= 46))
    return (
        math.log1p(n), *shares.tolist(), float(-(present * np.log(present)).sum()),
        len(zlib.compress(text, 1)) / (n + 20), math.log1p(len(tokens)), float(lengths.mean()) if len(tokens) else 0.0,
        len(set(tokens)) / m, sum(map(eq, tokens, tokens[1:])) / m, float((lengths <= 3).mean()) if len(tokens) else 0.0,
        1 - float(letters.mean()) if len(tokens) else 0.0, math.log1p(int(lengths.max())) if len(tokens) else 0.0,
        math.log1p(n / len(lines)), len(set(lines)) / len(lines), sum(map(bytes.isupper, tokens)) / m,
    )


def _described(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([describe(t) for t in batch["utf8"].to_pylist()], np.float32)


def descriptions(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = _described(batch)
        return pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(values[:, i]) for i in range(len(FEATURES))]],
                                          names=["doc_id", *FEATURES])

    return docs.select("doc_id", binary_text().alias("utf8")).mapInArrow(per_batch(work, TEXTS), f"doc_id long, {_SCHEMA}")


class Model:
    """Additive over cuts: logit = bias + sum of the weight of each feature's interval."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        self.first = np.cumsum([0] + [len(c) + 1 for c in cuts[:-1]])
        self.weights, self.bias = np.zeros(sum(len(c) + 1 for c in cuts)), 0.0

    def cells(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, values[:, i], "left") + f
                         for i, (c, f) in enumerate(zip(self.cuts, self.first))], axis=1)

    def logits(self, cells: np.ndarray) -> np.ndarray:
        return self.weights[cells].sum(axis=1) + self.bias

    def scores(self, values: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(self.cells(values)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_pu(model: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float,
           steps: int = 400, rate: float = 0.05, ridge: float = 7e-4) -> Model:
    """Minimise the non-negative risk by Adam over the whole sample; cells of positive and unlabelled rows."""
    n_p, n_u, size = len(positive), len(unlabelled), len(model.weights)
    moments = np.zeros((2, size + 1))

    def spread(cells: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(cells.ravel(), np.repeat(per_row, cells.shape[1]), size), per_row.sum())

    for step in range(1, steps + 1):
        p, u = _sigmoid(model.logits(positive)), _sigmoid(model.logits(unlabelled))
        soft = lambda q: -np.log(np.maximum(1 - q, 1e-15))  # noqa: E731  loss of calling a row with score q bad
        negative = soft(u).mean() - prior * soft(p).mean()
        slope = spread(unlabelled, u / n_u) - prior * spread(positive, p / n_p)
        slope = slope + prior * spread(positive, (p - 1) / n_p) if negative >= 0 else -slope
        slope[:-1] += ridge * model.weights
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= move[-1]
    return model


def remainder(by: int, doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``by``."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def fit_quality(features: DataFrame, labels: DataFrame, fit_rows: int = 20_000, prior: float | None = None) -> Model | None:
    """The model for stored ``features``; learns from documents whose remainder by 4 is not 2.  None without positives."""
    cuts = features.agg(*[F.percentile_approx(f, _QUANTILES, 10_000).alias(f) for f in FEATURES]).first()
    if cuts[0] is None:
        return None
    seen = features.where(remainder(4) != 2)
    trusted = (labels.where(remainder(4) != 2).groupBy("doc_id").agg(F.min("quality").alias("q"))
               .where("q = 1").select("doc_id"))
    positives = seen.join(trusted, "doc_id", "left_semi")

    store, drawn = Stored(features.sparkSession, "quality-sample"), []

    def sample(rows: DataFrame) -> np.ndarray:  # bounded by fit_rows
        # written first: collecting a limit sends as many rows from every partition
        drawn.append(f"drawn{len(drawn)}")
        rows = store.save(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select(*FEATURES), drawn[-1])
        return rows.toPandas().to_numpy(np.float32).reshape(-1, len(FEATURES))

    model = Model([np.unique(np.array(cuts[f], np.float32)) for f in FEATURES])
    p = sample(positives)
    if not len(p):
        return None
    if prior is None:
        # the first model sees one half of the documents, its scores are counted on the other
        half = F.xxhash64(F.lit("half"), "doc_id") % 2 == 0
        first = fit_pu(Model(model.cuts), *[model.cells(sample(rows.where(half))) for rows in (positives, seen)], 0.5, ridge=1e-2)
        prior = estimate_prior(first, seen.where(~half), positives.where(~half))
    return fit_pu(model, model.cells(p), model.cells(sample(seen)), prior)


def estimate_prior(first: Model, everything: DataFrame, positives: DataFrame, levels: int = 200) -> float:
    """Share of good texts among all: the lowest ratio of both tails above a level that four fifths of the positives reach."""

    def tail(rows: DataFrame) -> np.ndarray:
        counts = np.zeros(levels)
        for level, n in _levelled(rows, first, levels).groupBy("level").count().collect():  # at most ``levels`` rows
            counts[level] = n
        return counts[::-1].cumsum()[::-1] / max(1.0, counts.sum())

    p, u = tail(positives), tail(everything)
    return float(np.clip((u / np.maximum(p, 1e-9))[p >= 0.8].min(), 0.05, 0.99))


def _levelled(rows: DataFrame, model: Model, levels: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.scores(_columns(batch))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum((scores * levels).astype(np.int32), levels - 1))], names=["level"])

    return rows.select(*FEATURES).mapInArrow(per_batch(work), "level int")


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch[f].to_numpy() for f in FEATURES], axis=1)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **fit) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    features = Stored(docs.sparkSession, "quality").save(descriptions(docs), "features")
    model = fit_quality(features, labels, **fit)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.scores(_columns(batch)) if model else np.ones(batch.num_rows)
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], names=["doc_id", "score"])

    scored = features.mapInArrow(per_batch(work), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **fit) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``.  Texts stay where they are: no shuffle."""
    store = Stored(docs.sparkSession, "quality")
    features = store.save(descriptions(docs), "features")
    model = fit_quality(features, labels, **fit)
    store.drop("features")
    if model is None:
        return docs
    text = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text).cast(pa.binary()).to_pylist()
        return batch.filter(pa.array(model.scores(np.array([describe(t or b"") for t in texts], np.float32)) >= threshold))

    return docs.mapInArrow(per_batch(work, TEXTS), docs.schema)
