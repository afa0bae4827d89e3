"""Previous and next reading per series without one task per series.

``lag``/``lead`` over a plain per-series window puts a whole series into one task.  Here the
time axis is cut into chunks: the window runs inside (series, chunk), and only the rows at a
chunk border take their neighbour from a small table with one row per (series, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOUR = 3_600                     # default width of a chunk: a day of a busy series may not fit a task


def epoch_seconds(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def chunk_of(ts: Column | str, chunk_seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / chunk_seconds).cast("bigint")


def with_neighbours(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    values: Sequence[str],
    *,
    ties: Sequence[str] = (),
    previous: str | None = "prev",
    following: str | None = "next",
    chunk_seconds: int = HOUR,
) -> DataFrame:
    """Add structs ``previous`` / ``following`` holding ``ts`` and ``values`` of the adjacent rows."""
    key, chunk = "_pg_key", "_pg_chunk"
    order = [ts, *ties]
    payload = F.struct(ts, *values)
    # The series columns travel as one struct: structs compare equal on missing labels, so plain
    # equality serves the window, the aggregation and the join alike.  The explicit exchange is
    # the only one of the full data; where both uses need the same columns they share its output.
    chunked = df.select(
        *[c for c in df.columns if c not in series],
        F.struct(*series).alias(key),
        chunk_of(ts, chunk_seconds).alias(chunk),
    ).repartition(key, chunk)
    inside = W.partitionBy(key, chunk).orderBy(*order)

    borders = chunked.groupBy(key, chunk).agg(
        F.max_by(payload, F.struct(*order)).alias("_last"),
        F.min_by(payload, F.struct(*order)).alias("_first"),
    )
    # one row per (series, chunk): the number of chunks in the covered period bounds each group
    across = W.partitionBy(key).orderBy(chunk)
    borders = borders.select(
        key, chunk,
        F.lag("_last").over(across).alias("_from_before"),
        F.lead("_first").over(across).alias("_from_after"),
    )

    out = chunked
    if previous:
        out = out.withColumn(previous, F.lag(payload).over(inside))
    if following:
        out = out.withColumn(following, F.lead(payload).over(inside))
    out = out.join(borders, [key, chunk], "left")
    if previous:
        out = out.withColumn(previous, F.coalesce(previous, "_from_before"))
    if following:
        out = out.withColumn(following, F.coalesce(following, "_from_after"))
    added = [c for c in (previous, following) if c]
    return out.select(*[F.col(f"{key}.{c}").alias(c) if c in series else F.col(c) for c in df.columns], *added)


def trailing_sum(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    window_seconds: int,
    name: str,
    *,
    chunk_seconds: int = HOUR,
) -> DataFrame:
    """Sum of ``value`` over the last ``window_seconds`` (left end open) at every row.

    Time is cut into blocks as wide as the window, so a frame is the start of its row's own block and the end of the
    block before.  Both are running sums: no frame is added up again, however many rows it holds.  Each row is sent
    twice, to its own block and, one window later, to the next.  ``chunk_seconds`` has no part in this.
    """
    width = window_seconds * 1_000_000
    micros, block, at, home = "_pg_us", "_pg_block", "_pg_at", "_pg_home"
    start = F.col(micros) - F.pmod(F.col(micros), F.lit(width))
    places = [F.struct((start + gap).alias(block), (F.col(micros) + gap).alias(at), F.lit(gap == 0).alias(home)) for gap in (0, width)]
    spread = df.withColumn(micros, epoch_micros(ts)).where(F.col(micros).isNotNull()).select(*df.columns, F.inline(F.array(*places)))
    parts = W.partitionBy(*series, block)
    own = F.sum(F.when(F.col(home), F.col(value))).over(parts.orderBy(at).rangeBetween(W.unboundedPreceding, 0))
    # rows of the block before leave the frame one window after their time
    before = F.sum(F.when(~F.col(home), F.col(value))).over(parts.orderBy(F.desc(at)).rangeBetween(W.unboundedPreceding, -1))
    total = F.coalesce(F.col("_pg_own") + F.col("_pg_before"), F.col("_pg_own"), F.col("_pg_before"))
    kind = df.select(F.sum(value)).schema[0].dataType
    return (
        spread.withColumns({"_pg_own": own, "_pg_before": before})
        .where(home)
        .withColumn(name, total.cast(kind))
        .drop("_pg_own", "_pg_before", block, at, home)
    )
