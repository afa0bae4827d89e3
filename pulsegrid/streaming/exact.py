"""Raw to clean as an idempotent micro-batch: bad records apart, repeats dropped exactly, no state store.

Each batch writes folders of its own, named by its number: ``clean``, ``bad``, ``seen`` (the keys it added) and,
last, ``counts``, which makes it count.  A batch that is run again after a failure reads only what batches
before it have left and overwrites its own folders, so its result is the same.

*Repeats.*  Keys seen are a table cut by event date and key hash.  A batch of new rows first asks one Bloom filter
per touched cut (bits as bitmaps, written with the keys); only keys that a filter may hold are looked up, in
their cuts alone.  A repeat has the keys and the event time of the first; however late it comes, its cut is still
there.  Cuts of dates that cannot come again may be deleted like any partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

_PAGE = 32_768  # bits of one of Spark's bitmaps


@dataclass(frozen=True)
class ExactSpec:
    """keys (with the event time among them or beside them) tell rows apart; ``good`` is NULL or false for a bad record."""

    root: str
    keys: Sequence[str]
    event_time: str
    good: Column
    raw: Sequence[str] = ()          # columns kept of a bad record; all by default
    cuts: int = 16                   # of one event date
    pages: int = 16                  # bitmap pages of a cut's filter: 2**19 bits
    probes: int = 4


def _folder(spec: ExactSpec, name: str) -> str:
    return f"{spec.root.rstrip('/')}/{name}"


def _read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """A zone's table, of batches before one."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return table if before is None else table.where(F.col("batch") < before)


def _bits(spec: ExactSpec) -> Column:
    """The places of a key in the filter of its cut: page and bit."""
    places = [F.pmod(F.xxhash64("key", F.lit(i)), F.lit(spec.pages * _PAGE)) for i in range(spec.probes)]
    return F.explode(F.array(*[F.struct(F.floor(p / _PAGE).cast("int").alias("page"), (p % _PAGE).cast("int").alias("bit")) for p in places]))


def _maybe_seen(new: DataFrame, filters: DataFrame, spec: ExactSpec) -> DataFrame:
    """day, cut and key of the rows that a filter of an earlier batch may hold."""
    asked = new.select("day", "cut", "key", _bits(spec).alias("at")).select("day", "cut", "key", "at.*")
    byte = F.conv(F.hex(F.substr("bitmap", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = asked.join(filters, ["day", "cut", "page"]).where(
        F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)) % 2 == 1)
    # all probes must hit; hits may come from several batches, which only asks for one look-up more
    return (found.groupBy("day", "cut", "key").agg(F.count_distinct("page", "bit").alias("hits"))
            .join(asked.groupBy("day", "cut", "key").agg(F.count_distinct("page", "bit").alias("all")), ["day", "cut", "key"])
            .where("hits = all").select("day", "cut", "key"))


def apply_batch(batch: DataFrame, number: int, spec: ExactSpec) -> None:
    """One micro-batch: good rows not seen before to ``clean``, bad ones to ``bad``, and their counts."""
    spark = batch.sparkSession
    batch = batch.withColumn("_good", F.coalesce(spec.good, F.lit(False))).persist()
    held = [batch]
    try:
        bad = batch.where("NOT _good").drop("_good")
        bad = bad.select(*spec.raw) if spec.raw else bad
        key = F.to_json(F.struct(*spec.keys, spec.event_time))
        good = batch.where("_good").drop("_good").withColumns({"key_": key, "day_": F.to_date(spec.event_time)})
        first = F.row_number().over(Window.partitionBy("key_").orderBy(*[c for c in batch.columns if c != "_good"]))
        good = good.withColumn("turn_", first).where("turn_ = 1").drop("turn_")
        good = good.withColumn("cut_", F.pmod(F.xxhash64("key_"), F.lit(spec.cuts)).cast("int"))
        keys = good.select(F.col("day_").alias("day"), F.col("cut_").alias("cut"), F.col("key_").alias("key"))
        filters, seen = _read(spark, _folder(spec, "filters"), number), _read(spark, _folder(spec, "seen"), number)
        if filters is not None and seen is not None:
            maybe = _maybe_seen(keys, filters, spec).persist()
            held.append(maybe)
            if not maybe.isEmpty():      # only the cuts of these keys are read
                known = seen.join(maybe, ["day", "cut", "key"], "left_semi").select(F.col("key").alias("key_")).distinct()
                good = good.join(known, "key_", "left_anti")
        number_ = f"batch={number}"
        clean = good.drop("key_", "day_", "cut_")
        clean.write.mode("overwrite").parquet(f"{_folder(spec, 'clean')}/{number_}")
        bad.write.mode("overwrite").parquet(f"{_folder(spec, 'bad')}/{number_}")
        added = good.select(F.col("day_").alias("day"), F.col("cut_").alias("cut"), F.col("key_").alias("key")).persist()
        held.append(added)
        added.write.mode("overwrite").partitionBy("day", "cut").parquet(f"{_folder(spec, 'seen')}/{number_}")
        pages = (added.select("day", "cut", _bits(spec).alias("at")).groupBy("day", "cut", "at.page")
                 .agg(F.bitmap_construct_agg(F.col("at.bit").cast("long")).alias("bitmap")))
        pages.write.mode("overwrite").partitionBy("day", "cut").parquet(f"{_folder(spec, 'filters')}/{number_}")
        counts = batch.agg(F.count("*").alias("n_read"), F.count_if("_good").alias("n_good"), F.count_if(~F.col("_good")).alias("n_bad"))
        counts = counts.withColumn("n_clean", added.agg(F.count("*")).scalar())
        counts.withColumn("n_repeated", F.col("n_good") - F.col("n_clean")).coalesce(1).write.mode("overwrite").parquet(
            f"{_folder(spec, 'counts')}/{number_}")
    finally:
        for frame in held:
            frame.unpersist()


def start_exact(stream: DataFrame, spec: ExactSpec, every: str | None = "30 seconds") -> StreamingQuery:
    """:func:`apply_batch` on every micro-batch of a stream of parsed messages."""
    writer = stream.writeStream.foreachBatch(lambda batch, number: apply_batch(batch, number, spec))
    writer = writer.option("checkpointLocation", f"{spec.root.rstrip('/')}-checkpoint")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_exact(spark: SparkSession, spec: ExactSpec, zone: str = "clean") -> DataFrame:
    """``clean`` or ``bad`` rows, or ``counts``, of the batches that count."""
    done = spark.read.parquet(_folder(spec, "counts"))
    if zone == "counts":
        return done
    rows = spark.read.parquet(_folder(spec, zone))
    return rows.join(done.select("batch"), "batch", "left_semi").drop("batch")
