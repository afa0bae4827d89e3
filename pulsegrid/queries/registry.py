from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if its result can be stated in SQL, the statement to compare with."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the counter ``k`` of ``props`` and the value as an exact decimal."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.col("value").cast("decimal(12,2)").alias("value"),
        F.from_json("props", "k BIGINT")["k"].alias("k"),
    )


# The same relation for the SQL statements.
EVENTS_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events)"""
