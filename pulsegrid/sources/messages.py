"""Messages: stream sources, the raw envelope, JSON payloads in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Columns of the raw envelope, in stored order.
ENVELOPE = "key STRING, value STRING, topic STRING, kafka_timestamp TIMESTAMP, ingestion_ts TIMESTAMP"


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Kafka topic as a stream; needs the Kafka connector package on the cluster's class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )


def parquet_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """Growing Parquet folder as a stream with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def envelope(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Broker records (key, value, topic, timestamp) as raw rows; the payload stays unparsed."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("topic"),
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingestion_ts"),
    )


def keyed_messages(records: DataFrame, key: str | None, columns: Sequence[str], missing_key: str = "unknown") -> DataFrame:
    """Records as (key, JSON value) pairs; without a key column all keys are NULL."""
    name = F.coalesce(F.col(key).cast("string"), F.lit(missing_key)) if key else F.lit(None).cast("string")
    return records.select(name.alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def payload_columns(
    raw: DataFrame, schema: str, fields: Mapping[str, str], keep: Sequence[str] = ("ingestion_ts",), value: str = "value"
) -> DataFrame:
    """Parse the JSON payload and flatten it: ``fields`` maps output column -> path in the payload.

    Unreadable parts become NULL (permissive), so no message is lost at this stage.
    """
    parsed = raw.withColumn("_payload", F.from_json(F.col(value), schema))
    return parsed.select(*[F.col(f"_payload.{path}").alias(name) for name, path in fields.items()], *keep)


def bad_payloads(raw: DataFrame, schema: str, required: str, value: str = "value") -> DataFrame:
    """Raw rows whose payload has no usable ``required`` field, kept whole for inspection."""
    return raw.where(F.from_json(F.col(value), schema)[required].isNull())
