"""Envelopes, JSON payloads, mixed files and file exports."""

from pyspark.sql import functions as F

from pulsegrid.functions import digest_sum, row_digest
from pulsegrid.session import scratch_path
from pulsegrid.sources import (
    bad_payloads, compact, envelope, export_csv, inventory, inventory_report, keyed_messages, mixed_folder,
    format_sizes, payload_columns,
)

from .registry import EVENTS_SQL, events, query, table


@query("raw_envelope", """
SELECT CAST(user_id AS VARCHAR) AS key, props AS value, event_type AS topic, ts AS kafka_timestamp,
       ts + INTERVAL 30 SECOND AS ingestion_ts
FROM events
""")
def raw_envelope(spark, sf):
    records = table(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.encode("props", "UTF-8").alias("value"), F.col("event_type").alias("topic"),
        F.col("ts").alias("timestamp"),
    )
    return envelope(records, F.col("timestamp") + F.expr("INTERVAL 30 SECONDS"))


@query("keyed_json_publish", f"""
WITH {EVENTS_SQL}
SELECT coalesce(CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END, 'unknown') AS key,
       CAST(to_json(struct_pack(event_id := event_id, event_type := event_type, k := k)) AS VARCHAR) AS value
FROM ev
""")
def keyed_json_publish(spark, sf):
    # errors carry no usable sender
    rows = events(spark, sf).withColumn("sender", F.when(F.col("event_type") != "error", F.col("user_id")))
    return keyed_messages(rows, "sender", ["event_id", "event_type", "k"])


_STATION = "stationcode STRING, capacity INT, position STRUCT<lon: DOUBLE, lat: DOUBLE>"
_STATION_FIELDS = {"stationcode": "stationcode", "capacity": "capacity", "longitude": "position.lon",
                   "latitude": "position.lat"}


def _payloads(spark, sf):
    """Events as JSON text: errors are cut off in the middle, views carry a fractional capacity."""
    rows = table(spark, sf, "events").withColumn("k", F.from_json("props", "k INT")["k"])
    position = F.struct(F.col("value").alias("lon"), (F.col("value") / 4).alias("lat"))
    sound = F.to_json(F.struct(F.col("user_id").alias("stationcode"), F.col("k").alias("capacity"),
                               position.alias("position")))
    partial = F.to_json(F.struct(F.col("user_id").alias("stationcode"), (F.col("k") + 0.5).alias("capacity"),
                                 position.alias("position")))
    value = (
        F.when(F.col("event_type") == "error", F.expr("substr(props, 1, 4)"))
        .when(F.col("event_type") == "view", partial)
        .otherwise(sound)
    )
    return rows.select("event_id", value.alias("value"))


@query("json_parse_flatten", f"""
WITH {EVENTS_SQL}
SELECT CASE WHEN e.event_type <> 'error' THEN CAST(e.user_id AS VARCHAR) END AS stationcode,
       CAST(CASE WHEN e.event_type NOT IN ('error', 'view') THEN k END AS INTEGER) AS capacity,
       CASE WHEN e.event_type <> 'error' THEN e.value END AS longitude,
       CASE WHEN e.event_type <> 'error' THEN e.value / 4 END AS latitude,
       event_id
FROM events e JOIN (SELECT event_id, k FROM ev) USING (event_id)
""")
def json_parse_flatten(spark, sf):
    return payload_columns(_payloads(spark, sf), _STATION, _STATION_FIELDS, ["event_id"])


@query("bad_payloads", """
SELECT event_id, substr(props, 1, 4) AS value FROM events WHERE event_type = 'error'
""")
def bad_payload_rows(spark, sf):
    return bad_payloads(_payloads(spark, sf), _STATION, "stationcode")


@query("mixed_source_union", """
SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), NULL FROM supplier
""")
def mixed_source_union(spark, sf):
    folder = scratch_path(spark, "mixed")
    table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    ).write.parquet(f"{folder}/columnar")
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    export_csv(suppliers, f"{folder}/text")
    return mixed_folder(spark, folder).select(
        F.col("key").cast("bigint").alias("key"), "name", F.col("nation").cast("bigint").alias("nation"), "segment")


@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, sf):
    orders = table(spark, sf, "orders")
    folder = scratch_path(spark, "csv")
    export_csv(orders, folder)
    return spark.read.schema(orders.schema).option("header", "true").csv(folder)


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus"]
_PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# prices are compared as exact decimals, whose text is the same in both engines
_LINE_SQL = ", ".join([*(f"coalesce(CAST(CAST({c} AS DECIMAL(18, 4)) AS VARCHAR), '\\N')" for c in _PRICES), *(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in _LINE)])


@query("compaction_preserves_rows", f"""
WITH s AS (SELECT count(*) AS n,
  CAST(sum(CAST('0x' || substr(sha256(concat_ws(chr(31), {_LINE_SQL})), 1, 15) AS BIGINT)) AS VARCHAR) AS c
  FROM lineitem)
SELECT 'after' AS side, n AS n_rows, c AS checksum FROM s UNION ALL SELECT 'before', n, c FROM s
""")
def compaction_preserves_rows(spark, sf):
    many, few = scratch_path(spark, "many"), scratch_path(spark, "few")
    table(spark, sf, "lineitem").repartition(6 * spark.sparkContext.defaultParallelism).write.parquet(many)
    after = compact(spark, many, few)

    def side(df, label):
        return df.agg(F.lit(label).alias("side"), F.count(F.lit(1)).alias("n_rows"),
                      digest_sum(row_digest([*(F.col(c).cast("decimal(18, 4)") for c in _PRICES), *_LINE])).alias("checksum"))

    return side(spark.read.parquet(many), "before").unionByName(side(after, "after"))


@query("zone_inventory")
def zone_inventory(spark, sf):
    return inventory_report(inventory(spark, {"tables": sf}))


@query("format_sizes")
def sizes_by_format(spark, sf):
    return format_sizes(table(spark, sf, "orders"), scratch_path(spark, "formats"))
