"""Language-model scores of whole documents.

Tokens are the words of a text (A-Z lowered) and one end.  Counts of all tokens come from all training
documents (crc32 of the id by 10 is not 0) and give the base score, an additively smoothed unigram model:
sum of log10((c + 0.1) / (N + 0.1 * (V + 1))).

``score`` is the log10 probability under a gated recurrent model over the ``vocabulary`` most frequent words,
the end, and one token for all other words; such a word's probability is that token's times the word's smoothed
share among all others.  States are carried through the whole text.  Its output biases and all word shares are
those of all training documents, and so are the recurrent weights: in each epoch every token of every training
document is learnt from once, long texts window by window.  An epoch is a few rounds over growing slices of the
documents; in a round each task learns from its whole partition, ``fit_docs`` documents laid out at a time, and
the mean of the tasks' weights, by tokens, is where the next round begins.

The ``frequent`` most frequent words (64 bytes at most each, so a bounded table) are counted where the text is
read; all other words of all documents meet the corpus counts in a join.

Rows: NULL and empty texts hold the end alone; repeated rows are scored each; rows without an id are scored
but never trained on; without training documents every count is 0 and the model is the base model of an
empty corpus; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import Stored, all_words, binary_text, per_batch
from .quality import remainder
from .recurrent import Recurrent


@dataclass(frozen=True)
class LmSettings:
    vocabulary: int = 2046
    frequent: int = 200_000
    hidden: int = 16
    fit_docs: int = 2000  # laid out at a time; all are learnt from
    epochs: int = 1
    alpha: float = 0.1


_ROWS = 500  # texts whose words a task holds in a row


def word_counts(docs: DataFrame) -> DataFrame:
    """word (bytes) and n over all texts; words are added up where they are read, within a bound."""

    def work(batches):
        held: list[pa.Table] = []

        def summed():
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(
                ["word", "n_sum"]).rename_columns(["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                counts = pc.value_counts(all_words(batch["utf8"].slice(at, _ROWS))[0])
                held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
                if sum(map(len, held)) > 600_000:
                    held = [summed()]
                    if len(held[0]) > 400_000:
                        yield from held.pop().to_batches()
                    pa.default_memory_pool().release_unused()  # a worker lives on
        if held:
            yield from summed().to_batches()

    return docs.select(binary_text().alias("utf8")).mapInArrow(work, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


class _Tables:
    """What a task needs: the frequent words, their base log-probabilities, and the recurrent model."""

    def __init__(self, frequent: pa.Array, logs: np.ndarray, model: Recurrent, vocabulary: int):
        self.frequent, self.logs, self.model, self.vocabulary = frequent, logs, model, vocabulary


def _looked_up(value: _Tables, utf8: pa.Array) -> tuple[list[np.ndarray], pa.Table]:
    """Ids of every text, and its tokens, frequent and other words, their log-probabilities and its rare words."""
    found, starts = all_words(utf8)
    sizes = np.diff(starts)
    numbers = pc.index_in(found, value_set=value.frequent).fill_null(-1).to_numpy()
    known, inside = numbers >= 0, (numbers >= 0) & (numbers < value.vocabulary)
    text_of, logs = np.repeat(np.arange(len(sizes)), sizes), np.append(value.logs, 0.0)[numbers]  # -1: 0
    n_frequent, n_inside = np.bincount(text_of[known], minlength=len(sizes)), np.bincount(text_of[inside], minlength=len(sizes))
    rare_starts = pa.array(np.append(0, np.cumsum(sizes - n_frequent)), pa.int32())
    row = {"n_tokens": sizes + 1, "n_frequent": n_frequent, "n_other": sizes - n_inside, "frequent_log": np.bincount(text_of, logs, len(sizes)).astype(np.float64),
           "vocabulary_log": np.bincount(text_of[inside], logs[inside], len(sizes)).astype(np.float64),  # integers without words
           "rare": pa.ListArray.from_arrays(rare_starts, found.filter(pa.array(~known)))}
    ids, starts = np.where(inside, numbers, value.vocabulary), starts.tolist()
    return [ids[a:b] for a, b in zip(starts, starts[1:])], pa.table(row)


def _scored(tables, batch: pa.RecordBatch) -> pa.RecordBatch:
    value = tables.value
    texts, rows = [], []
    for at in range(0, batch.num_rows, _ROWS):
        ids, row = _looked_up(value, batch["utf8"].slice(at, _ROWS))
        texts += ids
        rows.append(row)
    pa.default_memory_pool().release_unused()  # a worker lives on
    scores = value.model.score(texts, value.vocabulary + 1) / np.log(10)
    columns = pa.concat_tables(rows).combine_chunks()
    columns = {n: columns[n].chunk(0) for n in columns.column_names} | {"row": batch["row"], "doc_id": batch["doc_id"], "model_log": pa.array(scores)}
    return pa.RecordBatch.from_arrays([columns[n] for n in _PART_NAMES], names=_PART_NAMES)


_PARTS = ("row long, doc_id long, n_tokens long, n_frequent long, n_other long, frequent_log double, vocabulary_log double, "
          "model_log double, rare array<binary>")
_PART_NAMES = [c.split()[0] for c in _PARTS.split(", ")]


def _numbered(vocabulary: pa.Array, batch: pa.RecordBatch) -> pa.RecordBatch:
    found, starts = all_words(batch["utf8"])
    numbers = pc.index_in(found, value_set=vocabulary).fill_null(len(vocabulary)).to_numpy()
    rows = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((4 * starts).astype(np.int32)), pa.py_buffer(numbers)])
    return pa.RecordBatch.from_arrays([batch["slice"], rows], names=["slice", "ids"])


_SLICES = (0, 1, 4, 16)  # the rounds of an epoch: weights are first averaged while tasks have learnt little
_CHUNK = 4096  # weights in a row
_GROUP = 256  # tasks whose weights are averaged at a time
_LESSON = "task int, chunk int, tokens long, weights binary"


def _learnt(start, end: int, fit_docs: int, rate: float, batches):
    """Weights after all documents of a partition, in chunks."""
    model = copy.deepcopy(start.value)
    learner, texts, held, tokens = model.learner(rate), [], 0, 0
    for batch in batches:
        for raw in batch["ids"].to_pylist():
            texts.append(np.frombuffer(raw, np.int32))
            held += len(texts[-1]) + 1
            if len(texts) >= fit_docs or held > 1 << 20:
                tokens += learner.learn(texts, end)
                texts, held = [], 0
    if texts:
        tokens += learner.learn(texts, end)
    if tokens:
        flat = model.weights()
        parts = [flat[at:at + _CHUNK].tobytes() for at in range(0, len(flat), _CHUNK)]
        n, task = len(parts), TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task] * n, pa.int32()), pa.array(range(n), pa.int32()),
                                          pa.array([tokens] * n, pa.int64()), pa.array(parts, pa.binary())],
                                         names=["task", "chunk", "tokens", "weights"])


def _mean(key: tuple, group: pa.Table) -> pa.Table:
    """The mean of weights of one chunk by tokens, under the first task's number."""
    group = group.sort_by("task")
    total, tokens = 0.0, group["tokens"].to_numpy()
    for n, raw in zip(tokens.tolist(), group["weights"]):
        total = total + n * np.frombuffer(raw.as_py(), np.float32).astype(np.float64)
    return pa.table({"task": group["task"].slice(0, 1), "chunk": pa.array([key[0].as_py()], pa.int32()),
                     "tokens": pa.array([tokens.sum()], pa.int64()),
                     "weights": pa.array([(total / tokens.sum()).astype(np.float32).tobytes()], pa.binary())})


def fit(model: Recurrent, lessons: DataFrame, end: int, of: LmSettings, rate: float = 0.01) -> int:
    """Fits ``model`` to all rows of ``lessons`` in each epoch; the number of tokens learnt from.

    Tasks' weights are averaged by groups of tasks first, so no task holds those of all.
    """
    context, learnt = lessons.sparkSession.sparkContext, 0
    for epoch in range(of.epochs):
        for low, high in zip(_SLICES, _SLICES[1:]):
            pace = rate * (0.4 if epoch == of.epochs - 1 and high == _SLICES[-1] else 1.0)
            start = context.broadcast(model)
            some = lessons.where((F.col("slice") >= low) & (F.col("slice") < high)).select("ids")
            found = some.mapInArrow(partial(_learnt, start, end, of.fit_docs, pace), _LESSON)
            found = found.groupBy("chunk", F.floor(F.col("task") / _GROUP)).applyInArrow(_mean, _LESSON)
            found = found.groupBy("chunk").applyInArrow(_mean, _LESSON).collect()  # as many rows as the model has chunks
            start.unpersist()
            if found:
                found.sort(key=lambda r: r.chunk)
                model.set_weights(np.concatenate([np.frombuffer(r.weights, np.float32) for r in found]))
                learnt += found[0].tokens
    return learnt


def lm_scores(docs: DataFrame, of: LmSettings = LmSettings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    store = Stored(spark, "lm")
    training = docs.where(remainder(10) != 0)
    counts = store.save(word_counts(training), "counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = training.count()
    n, v = sums[0] + ends, sums[1] + (ends > 0)
    below = n + of.alpha * (v + 1)

    # written first: collecting a limit sends as many rows from every partition
    top = store.save(counts.where(F.length("word") <= 64).orderBy(F.desc("n"), "word").limit(of.frequent), "top")
    top = top.orderBy(F.desc("n"), "word").toPandas()  # bounded
    frequent = pa.array([bytes(w) for w in top["word"]], pa.binary())
    size = min(of.vocabulary, len(frequent))
    top_counts = top["n"].to_numpy(np.float64)
    others = n - ends - top_counts[:size].sum()
    below_others = others + of.alpha * (v - size - (ends > 0) + 1)  # the other words, and one never seen
    model = Recurrent(np.append(top_counts[:size], [others, ends]), of.hidden)

    vocabulary = pa.array(frequent.to_pylist()[:size], pa.binary())  # a slice would be sent whole
    lessons = store.save(training.select(F.pmod(F.xxhash64("doc_id"), F.lit(_SLICES[-1])).cast("int").alias("slice"), binary_text(
        ).alias("utf8")).mapInArrow(per_batch(lambda batch: _numbered(vocabulary, batch), _ROWS), "slice int, ids binary"), "lessons")
    if ends:
        fit(model, lessons, size + 1, of)

    tables = spark.sparkContext.broadcast(_Tables(frequent, np.log10((top_counts + of.alpha) / below), model, size))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", binary_text().alias("utf8"))
    parts = store.save(rows.mapInArrow(per_batch(lambda batch: _scored(tables, batch)), _PARTS), "parts")

    rare = parts.select("row", F.explode("rare").alias("word")).join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10((F.coalesce("n", F.lit(0)) + of.alpha) / below)).alias("rare_log"),
        F.count("n").alias("n_rare"))
    end_log = float(np.log10((ends + of.alpha) / below))
    shift = float(np.log10(below / below_others))
    base = F.col("frequent_log") + F.coalesce("rare_log", F.lit(0.0))
    return parts.drop("rare").join(rare, "row", "left").select(
        "doc_id", F.coalesce(remainder(10) == 0, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (base + end_log).alias("base_score"),
        (F.col("model_log") + base - F.col("vocabulary_log") + F.col("n_other") * shift).alias("score"))
