"""What each filter of a corpus takes, in every order of the filters.

A document fails some subset of the filters, its mask.  All that any order of filters can report follows
from how many documents of a part have each mask, so documents are folded to at most one row per part and
mask, and one task walks the subsets of filters of a part in Gray-code order: each step turns one filter on
or off, every mask cell keeps the number of its active failures, and cells that come to or leave zero move
the count of survivors.  The counts after all subsets are stored; an order's step is the difference of two.

Rows: a NULL text counts as empty; a NULL source and an empty one are the same part; rows that repeat a
``doc_id`` are counted each, and never as copies of one another; a row without ``doc_id`` has no labels, is
no copy and makes no other row one.  Labels given more than once for a document hold if any row says so.
No documents give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, Stored, binary_text

FILTERS = "ABCDE"
COUNTS = ("n", "good", "toxic")

STEPS = pa.schema([
    ("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), ("kept", pa.int64()),
    ("removed", pa.int64()), ("redundant", pa.int64()), ("unique_fails", pa.int64()), ("good_lost", pa.int64()),
    ("toxic_lost", pa.int64()), ("shapley", pa.int64()),
])
STEPS_DDL = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
             "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at the text alone: few words, repeated words, capitals, mark-up."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def mask_cells(docs: DataFrame, labels: DataFrame, store: Stored) -> DataFrame:
    """part, mask and the documents, good ones and toxic ones of each cell.

    Equal texts fail the same text filters, so they fold by digest, part and labels before copies are
    counted: a text that a third of all rows share is one row per part and label pair.
    """
    mask = F.lit(0)
    for name, fails in text_failures(F.col("text")).items():
        mask = mask + F.when(fails, _bit(name)).otherwise(0)
    narrow = store.save(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), mask.cast("int").alias("mask"),
        F.unhex(F.sha2(binary_text(), 256)).alias("digest")), "narrow")
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"))
    kind = ["digest", "mask", "part", "is_good", "is_toxic"]
    labelled = (narrow.where("doc_id is not null").join(known, "doc_id", "left")
                .na.fill(False, ["is_good", "is_toxic"]))
    # rows of one id and text count as one member with several rows; a least member is no copy
    folded = store.save(
        labelled.groupBy("doc_id", *kind).agg(F.count("*").alias("rows"))
        .groupBy(*kind).agg(F.sum("rows").alias("n"), F.min(F.struct("doc_id", "rows")).alias("least")), "folded")
    first = folded.groupBy("digest").agg(F.min("least.doc_id").alias("first_id"), F.count("*").alias("kinds"),
                                         F.sum("n").alias("members"))
    copied = first.where("members > 1").select("digest", "first_id")
    fresh = F.when(F.col("first_id").isNull(), F.col("n")).when(
        F.col("least.doc_id") == F.col("first_id"), F.col("least.rows")).otherwise(0)
    parted = folded.join(copied, "digest", "left").withColumn("fresh", fresh)
    stray = (narrow.where("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n"))
             .select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")))

    def cells(mask: Column, n: str | Column) -> Column:
        n = F.col(n) if isinstance(n, str) else n
        return F.struct(mask.alias("mask"), n.alias("n"), F.when(F.col("is_good"), n).otherwise(0).alias("good"),
                        F.when(F.col("is_toxic"), n).otherwise(0).alias("toxic"))

    both = F.array(cells(F.col("mask"), "fresh"), cells(F.col("mask") + _bit("E"), F.col("n") - F.col("fresh")))
    rows = parted.select("part", F.explode(both).alias("cell")).select("part", "cell.*").unionByName(stray)
    return rows.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])


def survivors(cells: list[dict], filters: int = len(FILTERS)) -> list[tuple[int, ...]]:
    """Counts of documents that pass all filters of a subset, for every subset (a bit mask), by a Gray-code walk."""
    active = [0] * len(cells)
    alive = [sum(c[k] for c in cells) for k in COUNTS]
    states: list[tuple[int, ...]] = [()] * (1 << filters)
    states[0] = tuple(alive)
    subset = 0
    for step in range(1, 1 << filters):
        toggled = step & -step
        subset ^= toggled
        change = 1 if subset & toggled else -1
        for i, cell in enumerate(cells):
            if cell["mask"] & toggled:
                before, active[i] = active[i], active[i] + change
                if (before == 0) != (active[i] == 0):
                    for j, k in enumerate(COUNTS):
                        alive[j] -= change * cell[k]
        states[subset] = tuple(alive)
    return states


def order_steps(part: str, cells: list[dict]) -> Iterator[dict]:
    """All orders of the filters of one part, step by step, from the stored states."""
    states = survivors(cells)
    everything = (1 << len(FILTERS)) - 1
    n = len(FILTERS)
    fails = {f: states[0][0] - states[_bit(f)][0] for f in FILTERS}
    alone = {f: states[everything ^ _bit(f)][0] - states[everything][0] for f in FILTERS}
    # orders in which exactly the filters of a subset come before f
    shapley = {f: sum(factorial(s.bit_count()) * factorial(n - 1 - s.bit_count()) * (states[s][0] - states[s | _bit(f)][0])
                      for s in range(everything + 1) if not s & _bit(f)) for f in FILTERS}
    for order in permutations(FILTERS):
        done = 0
        for step, f in enumerate(order, 1):
            before, after = states[done], states[done | _bit(f)]
            done |= _bit(f)
            removed, good, toxic = (b - a for b, a in zip(before, after))
            yield {"part": part, "filter_order": "".join(order), "step": step, "kept": after[0], "removed": removed,
                   "redundant": fails[f] - removed, "unique_fails": alone[f], "good_lost": good, "toxic_lost": toxic,
                   "shapley": shapley[f]}


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_pylist(list(order_steps(row["part"], row["cells"])), schema=STEPS)


def audit(docs: DataFrame, labels: DataFrame, store: Stored | None = None) -> DataFrame:
    """One row per part, order of the five filters and step."""
    cells = mask_cells(docs, labels, store or Stored(docs.sparkSession, "filters"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))  # 32 cells at most
    return parts.mapInArrow(_walk, STEPS_DDL)
