"""Raw, clean and curated zones as Structured Streaming jobs.

Sources and sinks are arguments: the same code runs on Kafka, on a growing Parquet folder, with
a periodic trigger or with ``availableNow``.  Checkpoints live outside the data folders.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.latest import latest_per_key
from pulsegrid.plans.curate import STATION_SPEC, CurateSpec, curate_latest
from pulsegrid.plans.stations import INFO_FIELDS, INFO_PAYLOAD, STATUS_FIELDS, STATUS_PAYLOAD, WEATHER_FIELDS, WEATHER_PAYLOAD
from pulsegrid.sources.messages import ENVELOPE, envelope, parquet_stream, payload_columns
from pulsegrid.sources.tables import Published, prune_versions, publish, read_published

log = logging.getLogger(__name__)

KEPT_VERSIONS = 5  # snapshots a job leaves for readers that are still at work


class JobFolders(NamedTuple):
    data: str
    checkpoint: str


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(stream: DataFrame, folders: JobFolders, every: str | None = "30 seconds",
                 partition_by: Sequence[str] = (), name: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per checkpoint.  ``every=None`` drains
    what is available and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", folders.data)
    writer = writer.option("checkpointLocation", folders.checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, every).start()


def start_raw(messages: DataFrame, folders: JobFolders, every: str | None = "30 seconds",
              by_date: bool = False, ingested_at: Column | None = None) -> StreamingQuery:
    """Topic to raw zone.  ``by_date`` adds ``ingest_date`` partitions, which retention drops whole."""
    rows = envelope(messages, ingested_at)
    if not by_date:
        return start_append(rows, folders, every)
    return start_append(rows.withColumn("ingest_date", F.to_date("ingestion_ts")), folders, every, ["ingest_date"])


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str | None = None,
                 within: str | None = None) -> DataFrame:
    """Drop repeats, and nothing else: every key is remembered, in a state store on disk.

    With ``event_time`` and ``within`` only keys of that period are remembered, and rows that come later
    than it are dropped.
    """
    if event_time is None or within is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))


def clean_status(raw: DataFrame, within: str | None = None, by_ingestion: bool = False) -> DataFrame:
    """Status messages: typed columns, one row per station and message time, however late it comes.

    ``within`` bounds the remembered keys and drops rows later than it.  ``by_ingestion`` keeps one row per
    station and ingestion time instead, which folds what one micro-batch brings for a station.
    """
    rows = payload_columns(raw, STATUS_PAYLOAD, STATUS_FIELDS, ["kafka_timestamp", "ingestion_ts"])
    if by_ingestion:
        return deduplicated(rows.drop("kafka_timestamp"), ["stationcode", "ingestion_ts"])
    return deduplicated(rows, ["stationcode", "kafka_timestamp"], "kafka_timestamp", within).drop("kafka_timestamp")


def clean_weather(raw: DataFrame, within: str | None = None) -> DataFrame:
    """Weather messages: one row per observation time, however late it comes (but see ``within``)."""
    rows = payload_columns(raw, WEATHER_PAYLOAD, WEATHER_FIELDS, ["kafka_timestamp", "ingestion_ts"])
    return deduplicated(rows, ["weather_ts"], "kafka_timestamp", within).drop("kafka_timestamp")


def clean_info(raw: DataFrame) -> DataFrame:
    return payload_columns(raw, INFO_PAYLOAD, INFO_FIELDS)


def _version(batch_id: int) -> str:
    # a replayed batch must not overwrite the snapshot it is going to read
    return f"batch-{batch_id:012d}-{uuid.uuid4().hex[:8]}"


def _merge_latest(batch: DataFrame, root: str, key: str, newest_by: Sequence[str], version: str) -> Published | None:
    """Fold a micro-batch into the published newest-per-key table.

    Repeating a batch gives the same table, so a replay after a failure is harmless; the cost
    follows the batch and the number of keys, not the history.
    """
    spark = batch.sparkSession
    rows = batch.where(F.col(key).isNotNull())
    current = read_published(spark, root)
    if current is not None:
        rows = current.unionByName(rows)
    try:
        published = publish(latest_per_key(rows, [key], newest_by), root, version)
    except ValueError:
        return None                      # nothing to publish yet
    prune_versions(spark, root, KEPT_VERSIONS)
    return published


def latest_reference(key: str, newest_by: Sequence[str], root: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps a reference table with the newest row per key."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        _merge_latest(batch, root, key, newest_by, _version(batch_id))

    return apply


def start_reference(raw: DataFrame, root: str, checkpoint: str, every: str | None = "30 seconds",
                    first_wins: bool = False) -> StreamingQuery:
    """Station reference.  The newest version wins, so renamed stations arrive; ``first_wins``
    appends each code once and ignores later versions."""
    rows = clean_info(raw)
    if first_wins:
        return start_append(deduplicated(rows, ["stationcode"]), JobFolders(root, checkpoint), every)
    newest_by = ["ingestion_ts", "name", "capacity", "latitude", "longitude"]
    writer = rows.writeStream.foreachBatch(latest_reference("stationcode", newest_by, root))
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def start_curated(
    clean: DataFrame,
    reference: Callable[[], DataFrame],
    context: Callable[[], DataFrame],
    state_root: str,
    curated_root: str,
    checkpoint: str,
    *,
    spec: CurateSpec = STATION_SPEC,
    every: str | None = "120 seconds",
) -> StreamingQuery:
    """Curated snapshot maintained from the clean stream.

    Each trigger merges only the new rows into the newest-per-station state and publishes the
    enriched snapshot; the clean history is never scanned again.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        version = _version(batch_id)
        if _merge_latest(batch, state_root, spec.key, spec.newest_by, version) is None:
            return
        state = read_published(batch.sparkSession, state_root)
        try:
            publish(curate_latest(state, reference(), context(), spec), curated_root, version)
        except ValueError as problem:
            log.warning("curated snapshot kept: %s", problem)
            return
        prune_versions(batch.sparkSession, curated_root, KEPT_VERSIONS)

    writer = clean.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


# The three message kinds and their folders below a zone.
STATUS, INFO, WEATHER = "station_status", "station_information", "weather"

# Columns of the clean status table.
CLEAN_STATUS = (
    "stationcode STRING, numbikesavailable INT, numdocksavailable INT, mechanical INT, ebike INT, capacity INT, "
    "nom_arrondissement_communes STRING, ingestion_ts TIMESTAMP"
)


def start_station_raw(source: Callable[[str], DataFrame], root: str, every: str | None = "30 seconds",
                      kinds: Sequence[str] = (STATUS, INFO, WEATHER)) -> list[StreamingQuery]:
    """One independent query per message kind; ``source`` gives the stream of a kind.  Folders are cut by
    ingestion date, so that ``retain_days`` can drop whole days."""
    return [start_raw(source(kind), _zone(root, kind), every, by_date=True) for kind in kinds]


def start_station_clean(spark: SparkSession, raw_root: str, clean_root: str,
                        every: str | None = "30 seconds") -> list[StreamingQuery]:
    """Raw to clean for the three message kinds."""

    def raw(kind: str) -> DataFrame:
        return parquet_stream(spark, _zone(raw_root, kind).data, ENVELOPE)

    info = _zone(clean_root, INFO)
    return [
        start_append(clean_status(raw(STATUS)), _zone(clean_root, STATUS), every),
        start_reference(raw(INFO), info.data, info.checkpoint, every),
        start_append(clean_weather(raw(WEATHER)), _zone(clean_root, WEATHER), every),
    ]


def station_tables(spark: SparkSession, clean_root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean status, current reference and weather as batch tables."""
    reference = read_published(spark, _zone(clean_root, INFO).data)
    if reference is None:
        raise RuntimeError(f"no station reference below {clean_root} yet")
    return (spark.read.parquet(_zone(clean_root, STATUS).data), reference,
            spark.read.parquet(_zone(clean_root, WEATHER).data))


def start_station_curated(spark: SparkSession, clean_root: str, curated_root: str,
                          every: str | None = "120 seconds") -> StreamingQuery:
    """Curated snapshot that follows the clean status stream; only new rows are read."""
    clean = spark.readStream.schema(CLEAN_STATUS).parquet(_zone(clean_root, STATUS).data)
    root = curated_root.rstrip("/")
    return start_curated(
        clean, lambda: station_tables(spark, clean_root)[1], lambda: station_tables(spark, clean_root)[2],
        f"{root}-state", root, f"{root}-checkpoint", every=every)


def _zone(root: str, kind: str) -> JobFolders:
    root = root.rstrip("/")
    return JobFolders(f"{root}/{kind}", f"{root}-checkpoints/{kind}")


def run_curation(build: Callable[[], DataFrame], root: str, interval_seconds: float = 120,
                 rounds: int | None = None) -> int:
    """Rebuild and publish a snapshot periodically; a failing round is logged and the next one tries
    again.  Returns the number of successful rounds (``rounds=None`` runs until interrupted)."""
    done = good = 0
    while rounds is None or done < rounds:
        try:
            result = publish(build(), root)
            log.info("published %s with %d rows", result.version, result.rows_written)
            good += 1
        except Exception as problem:  # noqa: BLE001 - any failure of one round must not end the loop
            log.error("round failed: %s", problem)
        done += 1
        if rounds is None or done < rounds:
            time.sleep(interval_seconds)
    return good


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent commits of a query as (query, batch_id, committed_at, input_rows); Spark keeps the
    last 100.  Feed it to ``operators.stalls`` to find a query that runs but no longer commits."""
    rows = [
        (p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows) for p in query.recentProgress
    ]
    return spark.createDataFrame(
        rows, "query STRING, batch_id BIGINT, committed_at STRING, input_rows BIGINT"
    ).withColumn("committed_at", F.to_timestamp("committed_at"))
