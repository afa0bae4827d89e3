"""Questions over metric tables: counters, gauges, alert episodes and consumer lag.

A metric table has a time, series columns (labels) and a value.  A single series may hold a
large part of all samples, so nothing here orders a whole series in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .latest import latest_per_key
from .neighbours import HOUR, epoch_micros, trailing_sum, with_neighbours


def counter_increase(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    window_seconds: int,
    *,
    ties: Sequence[str] = (),
    name: str = "increase",
    chunk_seconds: int = HOUR,
) -> DataFrame:
    """Growth of a counter over the trailing window at every sample.

    A drop counts as a restart from zero.  The growth is the plain sum of the steps that end
    inside the window; it is not stretched to the window borders.
    """
    stepped = with_neighbours(
        df, series, ts, [value], ties=ties, previous="_prev", following=None, chunk_seconds=chunk_seconds
    )
    before = F.col(f"_prev.{value}")
    step = (
        F.when(before.isNull(), F.lit(0).cast(df.schema[value].dataType))
        .when(F.col(value) < before, F.col(value))
        .otherwise(F.col(value) - before)
    )
    stepped = stepped.withColumn("_step", step).drop("_prev")
    return trailing_sum(
        stepped, series, ts, "_step", window_seconds, name, chunk_seconds=chunk_seconds
    ).drop("_step")


def counter_rate(df: DataFrame, series: Sequence[str], ts: str, value: str, window_seconds: int, *,
                 ties: Sequence[str] = (), name: str = "rate", chunk_seconds: int = HOUR) -> DataFrame:
    """Increase per second over the trailing window."""
    grown = counter_increase(
        df, series, ts, value, window_seconds, ties=ties, name="_inc", chunk_seconds=chunk_seconds
    )
    return grown.withColumn(name, F.col("_inc").cast("double") / window_seconds).drop("_inc")


def gauge_latest(df: DataFrame, series: Sequence[str], newest_by: Sequence[str], value: str,
                 by: Sequence[str]) -> DataFrame:
    """Newest sample of every series, then maximum and sum per group of labels."""
    newest = latest_per_key(df, series, newest_by)
    return newest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_series"), F.max(value).alias("max_value"), F.sum(value).alias("sum_value")
    )


def gauge_ratio(df: DataFrame, at: Sequence[Column], metric: str, value: str, part: str, whole: str,
                threshold: float = 80.0) -> DataFrame:
    """``100 * max(part) / max(whole)`` per evaluation point, and whether it passes the threshold.

    Both gauges are picked by conditional aggregation in one exchange instead of a join.
    """
    peaks = df.where(F.col(metric).isin(part, whole)).groupBy(*at).agg(
        F.max(F.when(F.col(metric) == part, F.col(value))).alias("part_value"),
        F.max(F.when(F.col(metric) == whole, F.col(value))).alias("whole_value"),
    )
    ratio = F.try_divide(F.col("part_value") * 100, F.col("whole_value"))
    return peaks.withColumn("ratio", ratio).withColumn("is_over", F.coalesce(ratio > threshold, F.lit(False)))


def alert_episodes(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    predicate: Column,
    hold_seconds: int | Column,
    *,
    ties: Sequence[str] = (),
    chunk_seconds: int = HOUR,
) -> DataFrame:
    """Stretches during which ``predicate`` holds without a break, per series.

    ``hold_seconds`` may depend on the series.  ``state`` is PENDING for a stretch shorter than the hold time, FIRING for one that is long
    enough and still open at the end of the data, RESOLVED for one that fired and ended.
    ``last_true`` is the last sample of the stretch, ``resolved_at`` the sample that ended it.

    Only rows where the predicate changes, plus the last row of each series, go on to the
    second step, which pairs every start with the next change.
    """
    active = "_active"
    base = df.select(*series, ts, *ties, F.coalesce(predicate, F.lit(False)).alias(active))
    marked = with_neighbours(base, series, ts, [active], ties=ties, previous="_p", following="_n",
                             chunk_seconds=chunk_seconds)
    starts_or_ends = F.coalesce(F.col(f"_p.{active}"), F.lit(False)) != F.col(active)
    changes = (
        marked.where(starts_or_ends | F.col("_n").isNull())
        .select(*series, ts, *ties, active, F.col(f"_p.{ts}").alias("_before"),
                starts_or_ends.alias("_turn"))
    )
    paired = with_neighbours(changes, series, ts, [active, "_before"], ties=ties, previous=None, following="_e",
                             chunk_seconds=chunk_seconds)
    ended = ~F.col(f"_e.{active}")
    last_true = F.when(F.col("_e").isNull(), F.col(ts)).when(ended, F.col("_e._before")).otherwise(F.col(f"_e.{ts}"))
    episodes = paired.where(F.col(active) & F.col("_turn")).select(
        *series,
        F.col(ts).alias("started_at"),
        last_true.alias("last_true"),
        F.when(ended, F.col(f"_e.{ts}")).alias("resolved_at"),
    )
    held = epoch_micros("last_true") - epoch_micros("started_at") >= hold_seconds * 1_000_000
    state = F.when(~held, "PENDING").when(F.col("resolved_at").isNull(), "FIRING").otherwise("RESOLVED")
    return episodes.withColumn("state", state)


def alert_history(alerts: DataFrame, by: Sequence[str] = ("alertname", "severity", "composant")) -> DataFrame:
    """Alerts per group: how many in total and how many of them firing."""
    return alerts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_alerts"), F.count_if(F.col("status") == "firing").alias("n_firing")
    )


def consumer_lag(df: DataFrame, by: Sequence[str], lag_text: str, partition: str, *, per_worker: int = 20,
                 most_workers: int = 5) -> DataFrame:
    """Outstanding messages per group and topic, and the parallelism that would serve them.

    A lag of ``-`` (nothing committed yet) is left out of the sum; a group with only such
    partitions counts as zero.
    """
    lag = F.coalesce(F.sum(F.col(lag_text).try_cast("bigint")), F.lit(0)).cast("bigint")
    grouped = df.groupBy(*by).agg(lag.alias("total_lag"), F.count_distinct(partition).alias("n_partitions"))
    wanted = F.ceil(F.col("total_lag") / per_worker)
    most = F.least(F.lit(most_workers).cast("bigint"), F.col("n_partitions"))
    return grouped.withColumn("desired_workers", F.greatest(F.lit(1).cast("bigint"), F.least(wanted, most)))


def stalls(df: DataFrame, series: Sequence[str], ts: str, limit_seconds: int, *, ties: Sequence[str] = (),
           chunk_seconds: int = HOUR) -> DataFrame:
    """Pauses between consecutive commits of a series that are longer than the limit."""
    stepped = with_neighbours(df.select(*series, ts, *ties), series, ts, [], ties=ties, previous="_p",
                              following=None, chunk_seconds=chunk_seconds)
    pause = epoch_micros(ts) - epoch_micros(F.col(f"_p.{ts}"))
    return stepped.where(pause > limit_seconds * 1_000_000).select(
        *series, F.col(f"_p.{ts}").alias("stalled_from"), F.col(ts).alias("resumed_at"),
        (pause / 1_000_000).alias("pause_seconds"),
    )
