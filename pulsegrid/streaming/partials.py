"""Time buckets and extents as stored partial states that new batches merge into.

A state holds what later rows cannot change: sums and counts for means, the least (time, value) for firsts, maxima,
and exact bitmaps of integer entities.  Each micro-batch writes the states of its own rows to a folder named by its
number, so a batch that runs again overwrites itself and history is never read; ``fold`` merges what has gathered into
a snapshot, and a reader merges the snapshot with the batches after it.  Cost follows the batch and the number of
buckets.  Rows are counted as they come: drop repeats first (``streaming.exact``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.functions import to_whole
from pulsegrid.sources.tables import Published, publish, published_versions

_SNAPSHOT = "upto-"


@dataclass(frozen=True)
class BucketSpec:
    """The columns of ``operators.bucket_series``; means of DECIMAL columns do not depend on the order of merging."""

    keys: Sequence[str]
    ts: str
    width: str
    maxima: Sequence[str] = ()
    firsts: Sequence[str] = ()
    means: Sequence[str] = ()
    whole_means: bool = True
    bucket: str = "ts_bucket"

    def states(self, rows: DataFrame) -> DataFrame:
        """One state per entity and bucket; rows without a key or time belong to none."""
        complete = rows.dropna(subset=[*self.keys, self.ts])
        measures = [F.max(c).alias(f"max_{c}") for c in self.maxima]
        for c in self.firsts:
            at = F.when(F.col(c).isNotNull(), F.struct(F.col(self.ts).alias("at"), F.col(c).alias("value")))
            measures.append(F.min(at).alias(f"first_{c}"))
        for c in self.means:
            measures += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
        start = F.window(F.col(self.ts), self.width).start
        return complete.withColumn(self.bucket, start).groupBy(*self.keys, self.bucket).agg(*measures, F.count(F.lit(1)).alias("n_rows"))

    def merge(self, states: DataFrame) -> DataFrame:
        measures = [F.max(f"max_{c}").alias(f"max_{c}") for c in self.maxima]
        measures += [F.min(f"first_{c}").alias(f"first_{c}") for c in self.firsts]
        for c in self.means:
            kind = states.schema[f"sum_{c}"].dataType          # a sum of sums must not widen with every merge
            measures += [F.sum(f"sum_{c}").cast(kind).alias(f"sum_{c}"), F.sum(f"n_{c}").alias(f"n_{c}")]
        return states.groupBy(*self.keys, self.bucket).agg(*measures, F.sum("n_rows").alias("n_rows"))

    def finish(self, states: DataFrame) -> DataFrame:
        """The columns of ``bucket_series``."""

        def mean(c: str) -> Column:
            value = F.try_divide(F.col(f"sum_{c}").cast("double"), F.col(f"n_{c}"))
            return to_whole(value) if self.whole_means else value

        return states.select(
            *self.keys, self.bucket, *[F.col(f"max_{c}").alias(c) for c in self.maxima],
            *[F.col(f"first_{c}.value").alias(c) for c in self.firsts], *[mean(c).alias(c) for c in self.means])


@dataclass(frozen=True)
class ExtentSpec:
    """Rows, number of entities and covered period.  The entity is an integer from 0 on; each bitmap covers 32,768 of them,
    so the state grows with the entities and no set of them is gathered in one place."""

    entity: str
    ts: str

    def states(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.bitmap_bucket_number(self.entity).alias("page")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(self.entity)).alias("entities"),
            F.count(F.lit(1)).alias("n_rows"), F.min(self.ts).alias("first_ts"), F.max(self.ts).alias("last_ts"))

    def merge(self, states: DataFrame) -> DataFrame:
        return states.groupBy("page").agg(
            F.bitmap_or_agg("entities").alias("entities"), F.sum("n_rows").alias("n_rows"),
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def finish(self, states: DataFrame) -> DataFrame:
        """The row of ``series_extent``; rows without an entity count as rows only."""
        return states.agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("page").isNotNull(), F.bitmap_count("entities"))), F.lit(0)).alias("n_series"),
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


Spec = BucketSpec | ExtentSpec


def _batches(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/batches")
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _folded(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The last batch that the newest snapshot holds, and the snapshot's version."""
    number = F.regexp_extract("version", f"^{_SNAPSHOT}([0-9]+)", 1)
    try:
        newest = published_versions(spark, f"{root.rstrip('/')}/snapshots").where(number != "").agg(
            F.max(F.struct(number.cast("long").alias("upto"), "version"))).head()[0]
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return (-1, None) if newest is None else (newest["upto"], newest["version"])


def merge_batch(batch: DataFrame, number: int, root: str, spec: Spec) -> None:
    """``foreachBatch`` step: the states of a batch's rows, in a folder of their own.

    A batch that a snapshot already holds is left alone, so a late replay changes nothing.
    """
    if number > _folded(batch.sparkSession, root)[0]:
        spec.states(batch).write.mode("overwrite").parquet(f"{root.rstrip('/')}/batches/batch={number}")


def read_states(spark: SparkSession, root: str, spec: Spec, upto: int | None = None) -> DataFrame | None:
    """The merged states of all batches (up to one); None before the first."""
    done, version = _folded(spark, root)
    parts = []
    if version is not None:
        parts.append(spark.read.parquet(f"{root.rstrip('/')}/snapshots/version={version}"))
    newer = _batches(spark, root)
    if newer is not None:
        newer = newer.where(F.col("batch") > done)
        parts.append((newer if upto is None else newer.where(F.col("batch") <= upto)).drop("batch"))
    if not parts:
        return None
    return spec.merge(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))


def fold(spark: SparkSession, root: str, spec: Spec, upto: int) -> Published | None:
    """Merge all batches up to a finished one into a new snapshot; None if the newest holds them already.

    Readers see the old snapshot and its batches until the new one is published whole.  Folders of folded batches are
    not read again and may be deleted once no reader is at work on them.
    """
    if upto <= _folded(spark, root)[0]:
        return None
    states = read_states(spark, root, spec, upto)
    return None if states is None else publish(states, f"{root.rstrip('/')}/snapshots", f"{_SNAPSHOT}{upto:012d}", allow_empty=True)
