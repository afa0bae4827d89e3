"""Periodic runs of words: stretches that repeat a block of words at least twice, at any period.

A run is a longest stretch of words in which words ``q`` apart are equal, ``q`` its smallest period, of at least
``max(least, 2 q)`` words.  Let *agreements* of period ``q`` be the positions whose word equals the one ``q``
further on; a run is then a stretch of at least ``max(q, least - q)`` agreements.

* Each document is exploded into tiles for every octave of periods.  Boundaries lie so close that every such
  stretch of agreements holds one; a tile is ``TILE`` boundaries with the words that they need on both sides, so
  neighbouring tiles overlap.  Tiles at whose boundaries no few words recur within the octave hold no run and are
  left out: that test looks at hashes of all words, and equal words have equal hashes.
* A tile is solved by itself, wherever Spark puts it: Z-functions from each boundary onward and backward give,
  for all periods of the octave at once, how far the agreements reach, up to the next boundary either way.
* Fragments whose block of words is itself a repeat are dropped: the same stretch has that smaller period, and so
  is found under it.  Those that end inside their tile are kept only if they are a run.
* The rest is shuffled by document and period, and touching fragments are stitched.

Work grows with the words times the octaves; a document's tiles are dealt to all tasks.

Rows: a NULL text counts as empty and has no runs; rows are told apart by id and text, so rows that repeat both
give equal results; no rows give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Stored, binary_text

TILE = 16  # boundaries of a tile
LEAST = 12  # words of the shortest run
FIRST = 8  # the first octave holds all periods below

_TOGETHER = 100_000  # words of short texts that are looked at together
_MIX = np.uint64(0x9E3779B97F4A7C15)


def octaves(n: int, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
    """Periods [low, high) and the distance of boundaries, as long as a run of n words can have such a period."""
    low, high = 1, FIRST
    while low <= n // 2:
        yield low, high, min(max(q, least - q) for q in (low, *range(low, min(high, least + 1))))
        low, high = high, 2 * high


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words, in the order of their first use."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def _grams(ids: np.ndarray, salt: np.ndarray | int = 0) -> dict[int, np.ndarray]:
    """Hashes of 1, 3, 4 and 8 words from each position, as if zeros followed the end."""
    def joined(first: np.ndarray, after: int, second: np.ndarray) -> np.ndarray:
        out = (first ^ (first >> np.uint64(29))) * _MIX
        out[:max(len(out) - after, 0)] += second[after:]
        return out

    one = (ids.astype(np.uint64) + np.uint64(1)) * _MIX + np.asarray(salt, np.uint64)
    two = joined(one, 1, one)
    four = joined(two, 2, two)
    return {1: one, 3: joined(two, 2, one), 4: four, 8: joined(four, 4, four)}


def _open_boundaries(grams: dict[int, np.ndarray], low: int, high: int, apart: int) -> np.ndarray:
    """For each boundary whether words before or after it recur at a period of the octave.

    A stretch of ``apart`` agreements around a boundary has half of them on one of its sides.
    """
    size = max(s for s in grams if s <= max((apart + 1) // 2, 1))
    near = grams[size]
    n = len(near)
    before = np.arange(n, dtype=np.uint64)  # of the words that end here; too few words equal nothing
    before[size:] = near[:max(n - size, 0)]
    found = np.zeros(-(-n // apart), bool)
    if apart == low and high == 2 * low:
        for h in (near, before):
            rows = np.zeros((len(found) + 1) * low, np.uint64)
            rows[:n] = h
            rows = rows.reshape(-1, low)
            found |= (rows[1:] == rows[:-1, :1]).any(1)
    else:
        for h in (near, before):
            at = h[::apart]
            for q in range(low, min(high, n)):
                later = h[q::apart]
                found[:len(later)] |= at[:len(later)] == later
    return found


def open_tiles(ids: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, int, int, int]]:
    """low, high, distance and first boundary of the tiles that may hold a run."""
    if len(ids) < least:
        return
    grams = _grams(ids)
    for low, high, apart in octaves(len(ids), least):
        found = _open_boundaries(grams, low, high, apart)
        for tile in np.unique(np.flatnonzero(found) // TILE):
            yield low, high, apart, int(tile) * TILE * apart


def may_have_runs(texts: list[list[bytes]], least: int = LEAST) -> np.ndarray:
    """For each list of words whether any tile is left; one look at all lists together.

    Boundaries then lie elsewhere in a text than those of its tiles, which hold a run's agreements as well.
    """
    sizes = np.array([len(w) for w in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    ids = word_ids([w for words in texts for w in words])
    grams = _grams(ids, owner.astype(np.uint64) << np.uint64(40))
    out = np.zeros(len(texts), bool)
    for low, high, apart in octaves(int(sizes.max(initial=0)), least):
        at = np.flatnonzero(_open_boundaries(grams, low, high, apart)) * apart
        out[owner[at]] = True
    return out & (sizes >= least)


def z_function(s: list[int]) -> list[int]:
    """For each position how many items from there on equal those from the beginning on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(words: list[int], start: int, low: int, high: int, apart: int, first: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Period, start and end of the agreements around each boundary of a tile.

    ``words`` are those of the document from ``start`` on, as far as the tile needs them.
    """
    out = []
    end = start + len(words)
    for c in range(first, min(first + TILE * apart, end), apart):
        x = c - start
        onward = z_function(words[x:x + apart + high - 1])
        back = words[max(x - apart, 0):x][::-1]
        reach = min(high - 1, end - c)
        # reversed words up to c + reach - 1; the position before c + q is number reach - q
        turned = z_function(back + [-1] + words[max(x - apart, 0):x + reach][::-1]) if back else []
        for q in range(low, min(high, len(onward))):
            r = min(onward[q], apart)
            if r:
                span = turned[len(back) + 1 + reach - q] if back and q <= reach else 0
                if span + r >= max(q, least - q) or span == apart or r == apart:
                    out.append((q, c - span, c + r))
    return out


def merged(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Touching fragments of one period as one."""
    out: list[tuple[int, int, int]] = []
    for q, s, e in sorted(fragments):
        if out and out[-1][0] == q and s <= out[-1][2]:
            out[-1] = (q, out[-1][1], max(e, out[-1][2]))
        else:
            out.append((q, s, e))
    return out


def is_repeat(block: np.ndarray) -> bool:
    """Whether a block of words is a shorter block two or more times."""
    n = rest = len(block)
    factor = 2
    while rest > 1:
        if rest % factor == 0:
            if np.array_equal(block[n // factor:], block[:-(n // factor)]):
                return True
            while rest % factor == 0:
                rest //= factor
        factor = rest if factor * factor > rest else factor + 1
    return False


def tile_fragments(words: np.ndarray, start: int, low: int, high: int, apart: int, first: int, least: int = LEAST) -> list[tuple[int, int, int]]:
    """What a tile tells the other tiles of its document: runs, and parts of stretches that may go on beside it."""
    left, right = first - apart, first + TILE * apart
    return [(q, s, e) for q, s, e in merged(solve_tile(words.tolist(), start, low, high, apart, first, least))
            if (e - s >= max(q, least - q) or s <= left or e >= right) and not is_repeat(words[s - start:s - start + q])]


def kept_words(words: list[bytes], runs: list[dict]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    change = np.zeros(len(words) + 1, np.int32)
    for run in runs:
        change[run["start"] + run["period"]] += 1
        change[run["start"] + run["length"]] -= 1
    inside = np.cumsum(change[:-1]) > 0
    return b" ".join(w for w, drop in zip(words, inside) if not drop)


# -- Spark ---------------------------------------------------------------------------------------

_PREPARED = "doc_id long, key binary, plain string, text binary"
_TILES = "key binary, low int, high int, apart int, first long, start long, small boolean, words binary"
_FRAGMENTS = "key binary, period long, start long, end long"
RUN = "start: bigint, period: bigint, length: bigint"
_DONE = "doc_id long, collapsed_sha256 string, collapsed binary, runs array<struct<" + RUN + ">>"
_CHUNK = 8 << 20  # bytes of an output batch


def _batches(names: list[str], types: list[pa.DataType], rows: Iterator[tuple], size) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about _CHUNK bytes."""
    schema, held, weight = pa.schema(list(zip(names, types))), [], 0
    for row in rows:
        held.append(row)
        weight += 64 + size(row)
        if weight > _CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], schema=schema)


def _prepare(least: int):
    def looked_at(held):
        for (doc_id, text, words), may in zip(held, may_have_runs([h[2] for h in held], least)):
            key = hashlib.sha256(b"%s|" % str(doc_id).encode() + text).digest()[:16]
            yield doc_id, key, hashlib.sha256(b" ".join(words)).hexdigest(), text if may else None

    def rows(batches):
        held, count = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                words = text.split()
                held.append((doc_id.as_py(), text, words))
                count += len(words)
                if count > _TOGETHER:
                    yield from looked_at(held)
                    held, count = [], 0
        yield from looked_at(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(["doc_id", "key", "plain", "text"], [pa.int64(), pa.binary(), pa.string(), pa.binary()],
                        rows(batches), lambda r: len(r[3] or b""))

    return run


def _explode(least: int):
    def rows(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, ids = key.as_py(), word_ids(text.as_py().split())
                small = int(ids.max(initial=0)) < 1 << 16
                for low, high, apart, first in open_tiles(ids, least):
                    start = max(first - apart, 0)
                    part = ids[start:first + TILE * apart + high - 1]
                    yield key, low, high, apart, first, start, small, part.astype(np.uint16 if small else np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(["key", "low", "high", "apart", "first", "start", "small", "words"],
                        [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()],
                        rows(batches), lambda r: len(r[7]))

    return run


def _solve(least: int):
    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                key, low, high, apart, first, start, small, words = (batch.column(c)[i].as_py() for c in range(8))
                words = np.frombuffer(words, np.uint16 if small else np.uint32)
                for q, s, e in tile_fragments(words, start, low, high, apart, first, least):
                    yield key, q, s, e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(["key", "period", "start", "end"], [pa.binary(), pa.int64(), pa.int64(), pa.int64()], rows(batches), lambda r: 0)

    return run


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, text, runs in zip(*(batch.column(c) for c in range(3))):
                runs = runs.as_py() or []
                kept = kept_words(text.as_py().split(), runs)
                yield doc_id.as_py(), hashlib.sha256(kept).hexdigest(), kept if runs else None, runs

    run = pa.struct([("start", pa.int64()), ("period", pa.int64()), ("length", pa.int64())])
    return _batches(["doc_id", "collapsed_sha256", "collapsed", "runs"], [pa.int64(), pa.string(), pa.binary(), pa.list_(run)],
                    rows(), lambda r: len(r[2] or b"") + 24 * len(r[3]))


def stitched(fragments: DataFrame, least: int = LEAST) -> DataFrame:
    """key, start, period and length of every run, from the fragments of all tiles."""
    by = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= before, 0).otherwise(1)
    number = F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (fragments.withColumn("fresh", fresh).withColumn("number", number)
            .groupBy("key", "period", "number").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .where(F.col("end") - F.col("start") >= F.greatest(F.col("period"), least - F.col("period")))
            .select("key", "start", "period", (F.col("end") - F.col("start") + F.col("period")).alias("length")))


def find_runs(prepared: DataFrame, least: int = LEAST) -> DataFrame:
    """key, start, period and length of every run of the prepared texts."""
    # tiles are short for the work they make, so their number of tasks is not left to their bytes
    tasks = int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = (prepared.where("text is not null").select("key", "text").mapInArrow(_explode(least), _TILES)
             .repartition(tasks, "key", "low", "first"))
    return stitched(tiles.mapInArrow(_solve(least), _FRAGMENTS), least)


def runs_and_rest(docs: DataFrame, store: Stored | None = None, least: int = LEAST) -> DataFrame:
    """Per document its runs by start and period, and the text without repeats of a run's first period.

    doc_id, runs, collapsed (UTF-8, words joined by one space; NULL if no run takes any word) and collapsed_sha256.
    """
    store = store or Stored(docs.sparkSession, "runs")
    prepared = store.save(docs.select("doc_id", binary_text()).mapInArrow(_prepare(least), _PREPARED), "prepared")
    listed = find_runs(prepared, least).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    some = prepared.where("text is not null").join(listed, "key", "left").select("doc_id", "text", "runs").mapInArrow(_collapse, _DONE)
    none = prepared.where("text is null").select(
        "doc_id", F.col("plain").alias("collapsed_sha256"), F.lit(None).cast("binary").alias("collapsed"),
        F.array().cast("array<struct<" + RUN + ">>").alias("runs"))
    return some.unionByName(none).select("doc_id", "runs", "collapsed", "collapsed_sha256")


def longest(runs: Column) -> Column:
    """The longest run; of equally long ones the first, then the one with the least period."""
    ranked = F.array_sort(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.get(ranked, F.lit(0))
