"""The alert rules kept up batch by batch, without evaluating history again.

What a batch needs of the past is small and carried over: samples that are not due yet, the counter samples of
the longest window with one older sample per series (for its first step), and the episodes still open.  Each batch
writes folders of its own, named by its number (``carry``, ``episodes``, ``late`` and, last, ``done``); a batch that
runs again reads only what batches before it left and overwrites its own folders.

*Order.*  Samples are due once one that is ``delay_seconds`` newer has come; a time is evaluated once, with all its
samples.  A sample that comes for a time already evaluated (or has no time) cannot change an episode any more: it goes to
``late``, and ``evaluate_rules`` over the history takes it in.  Choose the delay so that there are none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.latest import latest_per_key
from pulsegrid.operators.neighbours import HOUR, epoch_micros
from pulsegrid.plans.alerts import RULES, AlertRule, breached, counter_metrics, described, rule_episodes, rule_values, series_key

_SAMPLE = ("ts", "metric", "labels", "value")
_NOTHING_DUE = -(1 << 62)


@dataclass(frozen=True)
class LiveAlerts:
    root: str
    rules: Sequence[AlertRule] = field(default_factory=lambda: RULES)
    delay_seconds: int = 60
    chunk_seconds: int = HOUR

    def folder(self, name: str, number: int | None = None) -> str:
        path = f"{self.root.rstrip('/')}/{name}"
        return path if number is None else f"{path}/batch={number}"

    @property
    def window_seconds(self) -> int:
        return max((r.window_seconds for r in self.rules), default=0)


def _done(spark: SparkSession, live: LiveAlerts) -> DataFrame | None:
    try:
        return spark.read.parquet(live.folder("done"))
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _before(spark: SparkSession, live: LiveAlerts, number: int) -> tuple[int | None, int]:
    """The batch whose state this one continues, and the time up to which it has evaluated."""
    done = _done(spark, live)
    last = None if done is None else done.where(F.col("batch") < number).agg(F.max(F.struct("batch", "due"))).first()[0]
    return (None, _NOTHING_DUE) if last is None else (last["batch"], last["due"])


def apply_samples(batch: DataFrame, number: int, live: LiveAlerts, last: bool = False) -> None:
    """One micro-batch of samples (ts, metric, labels, value).  ``last`` evaluates what is still waiting, too."""
    spark = batch.sparkSession
    earlier, due_before = _before(spark, live, number)
    wanted = sorted({m for r in live.rules for m in (r.metric, r.metric_of) if m})
    came = batch.where(F.col("metric").isin(wanted)).select(*_SAMPLE).persist()
    try:
        timely = F.coalesce(epoch_micros("ts") > due_before, F.lit(False))
        came.where(~timely).write.mode("overwrite").parquet(live.folder("late", number))
        samples = came.where(timely)
        if earlier is not None:
            samples = samples.unionByName(spark.read.parquet(live.folder("carry", earlier)))
        newest = samples.agg(F.max(epoch_micros("ts"))).first()[0]
        due = due_before if newest is None else max(due_before, newest - (0 if last else live.delay_seconds * 1_000_000))
        values = rule_values(samples.where(epoch_micros("ts") <= due), live.rules, live.chunk_seconds)
        values = values.where(epoch_micros("ts") > due_before).select("rule", "group", "ts", F.coalesce(breached(live.rules), F.lit(False)).alias("broken"))
        if earlier is not None:     # an open episode begins where it began and held until it was last seen
            still = spark.read.parquet(live.folder("episodes", earlier)).where("resolved_at IS NULL")
            ends = F.array_distinct(F.array("started_at", "last_true"))
            values = values.unionByName(still.select("rule", "group", F.explode(ends).alias("ts"), F.lit(True).alias("broken")))
        episodes = rule_episodes(values, live.rules, live.chunk_seconds, F.col("broken"))
        episodes.write.mode("overwrite").parquet(live.folder("episodes", number))
        counters = samples.where(F.col("metric").isin(counter_metrics(live.rules)) & (epoch_micros("ts") <= due))
        border = due - live.window_seconds * 1_000_000
        older = counters.where(epoch_micros("ts") <= border).withColumn("series_", series_key())
        older = latest_per_key(older, ["metric", "series_"], ["ts", "value"]).drop("series_")
        carry = samples.where(epoch_micros("ts") > due).unionByName(counters.where(epoch_micros("ts") > border)).unionByName(older)
        carry.write.mode("overwrite").parquet(live.folder("carry", number))
        spark.range(1).select(F.lit(due).cast("long").alias("due")).write.mode("overwrite").parquet(live.folder("done", number))
    finally:
        came.unpersist()


def start_alerts(samples: DataFrame, live: LiveAlerts, every: str | None = "30 seconds") -> StreamingQuery:
    """:func:`apply_samples` on every micro-batch of a stream of samples."""
    writer = samples.writeStream.foreachBatch(lambda batch, number: apply_samples(batch, number, live))
    writer = writer.option("checkpointLocation", f"{live.root.rstrip('/')}-checkpoint")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def live_episodes(spark: SparkSession, live: LiveAlerts) -> DataFrame:
    """All episodes so far, as ``evaluate_rules`` gives them: the closed ones of every batch and the open ones of the last."""
    done = _done(spark, live)
    if done is None:
        raise FileNotFoundError(f"no batch below {live.root} yet")
    newest = done.agg(F.max("batch")).scalar()
    rows = spark.read.parquet(live.folder("episodes")).join(done.select("batch"), "batch", "left_semi")
    return described(rows.where(F.col("resolved_at").isNotNull() | (F.col("batch") == newest)), live.rules)


def late_samples(spark: SparkSession, live: LiveAlerts) -> DataFrame:
    """Samples that came after their time was evaluated."""
    done = _done(spark, live)
    if done is None:
        raise FileNotFoundError(f"no batch below {live.root} yet")
    return spark.read.parquet(live.folder("late")).join(done.select("batch"), "batch", "left_semi").drop("batch")
