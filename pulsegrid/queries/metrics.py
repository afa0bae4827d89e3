"""Counters, gauges, alert episodes, alert log and consumer lag."""

from pyspark.sql import functions as F

from pulsegrid.operators import (
    alert_episodes, alert_history, consumer_lag, counter_increase, counter_rate, gauge_latest, gauge_ratio, stalls,
)
from pulsegrid.operators.neighbours import epoch_micros
from pulsegrid.plans.alerts import RULES, evaluate_rules
from pulsegrid.session import scratch_path
from pulsegrid.sources import alert_log
from pulsegrid.streaming import LiveAlerts, apply_samples, live_episodes

from .registry import EVENTS_SQL, events, query, table

HOUR = 3600


def _increase_sql(source, by, value, seconds, order="ts, event_id", name="increase"):
    """Steps by lag over the whole series, then a left-open range frame."""
    return f"""steps AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN {value} < before THEN {value} ELSE {value} - before END AS step
  FROM (SELECT *, lag({value}) OVER (PARTITION BY {by} ORDER BY {order}) AS before FROM {source})),
grown AS (SELECT *, sum(step) OVER (PARTITION BY {by} ORDER BY ts
    RANGE BETWEEN INTERVAL {seconds * 1_000_000 - 1} MICROSECOND PRECEDING AND CURRENT ROW) AS {name} FROM steps)"""


@query("counter_increase", f"""
WITH {EVENTS_SQL}, {_increase_sql('ev', 'event_type', 'k', HOUR)}
SELECT event_id, event_type, ts, k, CAST(increase AS BIGINT) AS increase FROM grown
""")
def increase(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "ts", "k")
    return counter_increase(rows, ["event_type"], "ts", "k", HOUR, ties=["event_id"])


@query("counter_rate", f"""
WITH {EVENTS_SQL}, {_increase_sql('ev', 'event_type', 'k', HOUR)}
SELECT event_id, event_type, ts, CAST(increase AS DOUBLE) / {HOUR} AS rate FROM grown
""")
def rate(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "ts", "k")
    return counter_rate(rows, ["event_type"], "ts", "k", HOUR, ties=["event_id"]).drop("k")


@query("gauge_latest", f"""
WITH {EVENTS_SQL}
SELECT event_type, count(*) AS n_series, max(k) AS max_value, CAST(sum(k) AS BIGINT) AS sum_value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev)
WHERE rn = 1 GROUP BY 1
""")
def latest_gauges(spark, sf):
    return gauge_latest(events(spark, sf), ["event_type", "user_id"], ["ts", "event_id"], "k", ["event_type"])


@query("gauge_ratio", """
WITH g AS (SELECT date_trunc('hour', ts) AS slot, max(value) FILTER (event_type = 'purchase') AS part_value,
                  max(value) FILTER (event_type = 'signup') AS whole_value
           FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1)
SELECT slot, part_value, whole_value, part_value * 100 / nullif(whole_value, 0) AS ratio,
       coalesce(part_value * 100 / nullif(whole_value, 0) > 80, false) AS is_over FROM g
""")
def ratio(spark, sf):
    slot = F.window("ts", "1 hour").start.alias("slot")
    return gauge_ratio(table(spark, sf, "events"), [slot], "event_type", "value", "purchase", "signup")


def _episodes_sql(source, by, predicate, hold, order="ts, event_id"):
    """Gaps and islands over whole series: number the islands by running changes."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""flagged AS (SELECT *, coalesce({predicate}, false) AS active FROM {source}),
turned AS (SELECT *, CASE WHEN active IS DISTINCT FROM lag(active) OVER ({part} ORDER BY {order}) THEN 1 ELSE 0 END AS turn,
                  lead(ts) OVER ({part} ORDER BY {order}) AS following FROM flagged),
numbered AS (SELECT *, sum(turn) OVER ({part} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM turned),
islands AS (SELECT {keys}island, min(ts) AS started_at, max(ts) AS last_true,
                   CASE WHEN count(*) = count(following) THEN max(following) END AS resolved_at
            FROM numbered WHERE active GROUP BY {keys}island),
episodes AS (SELECT {keys}started_at, last_true, resolved_at,
  CASE WHEN epoch_us(last_true) - epoch_us(started_at) < {hold * 1_000_000} THEN 'PENDING'
       WHEN resolved_at IS NULL THEN 'FIRING' ELSE 'RESOLVED' END AS state FROM islands)"""


@query("alert_episodes", f"""
WITH {EVENTS_SQL}, {_episodes_sql('ev', 'event_type', 'k >= 25', HOUR)} SELECT * FROM episodes
""")
def episodes(spark, sf):
    return alert_episodes(events(spark, sf), ["event_type"], "ts", F.col("k") >= 25, HOUR, ties=["event_id"])


@query("commit_stalls", """
WITH p AS (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM events)
SELECT event_type, before AS stalled_from, ts AS resumed_at,
       CAST(epoch_us(ts) - epoch_us(before) AS DOUBLE) / 1000000 AS pause_seconds
FROM p WHERE epoch_us(ts) - epoch_us(before) > 2100000000
""")
def commit_stalls(spark, sf):
    # 35 minutes without a commit
    return stalls(table(spark, sf, "events"), ["event_type"], "ts", 2100, ties=["event_id"])


def metric_table(spark, sf):
    """Events as samples of five metrics; the two storage gauges are sampled on the full hour.  A second, slow
    topic stands still at every sample; no rule watches it."""
    rows = events(spark, sf)
    kind = F.col("event_type")
    storage = kind.isin("purchase", "signup")
    metric = (
        F.when(kind == "click", "kafka_topic_partition_current_offset")
        .when(kind == "view", "up")
        .when(kind == "error", "prometheus_rule_evaluation_failures_total")
        .when(kind == "purchase", "minio_cluster_usage_total_bytes")
        .otherwise("minio_cluster_capacity_usable_total_bytes")
    )
    labels = (
        F.when(kind == "click", F.create_map(F.lit("topic"), F.lit("station_status")))
        .when(kind == "view", F.create_map(F.lit("job"), F.lit("kafka"), F.lit("instance"), F.lit("exporter")))
        .otherwise(F.create_map(F.lit("instance"), F.lit("main")))
    )
    hour = F.window("ts", "1 hour").start
    value = F.when(kind == "view", (F.col("k") >= 60).cast("double")).otherwise(
        F.when(storage, F.col("value").cast("double")).otherwise(F.col("k").cast("double")))
    samples = rows.where(kind.isNotNull()).select(
        F.when(storage, hour).otherwise(F.col("ts")).alias("ts"), metric.alias("metric"), labels.alias("labels"),
        value.alias("value"))
    slow = rows.where(kind == "click").select(
        "ts", F.lit("kafka_topic_partition_current_offset").alias("metric"),
        F.create_map(F.lit("topic"), F.lit("weather")).alias("labels"), F.lit(7.0).alias("value"))
    return samples.unionByName(slow)


def _rule_sql(name, severity, component, source, predicate, hold):
    return f"""SELECT '{name}' AS alertname, '{severity}' AS severity, '{component}' AS composant, * FROM (
WITH {EVENTS_SQL}, {source}, {_episodes_sql('folded', '', predicate, hold, order='ts')} SELECT * FROM episodes)"""


def _increase_rule_sql(kind):
    return f"""base AS (SELECT ts, event_type, CAST(k AS DOUBLE) AS value FROM ev WHERE event_type = '{kind}'),
{_increase_sql('base', 'event_type', 'value', 300, order='ts')},
folded AS (SELECT ts, sum(increase) AS value FROM grown GROUP BY 1)"""


_UP_SQL = """folded AS (SELECT ts, max(CASE WHEN k >= 60 THEN 1 ELSE 0 END) AS value FROM ev WHERE event_type = 'view' GROUP BY 1)"""
_FULL_SQL = """folded AS (SELECT date_trunc('hour', ts) AS ts,
  CAST(max(value) FILTER (event_type = 'purchase') AS DOUBLE) * 100
  / nullif(CAST(max(value) FILTER (event_type = 'signup') AS DOUBLE), 0) AS value
  FROM ev WHERE event_type IN ('purchase', 'signup') GROUP BY 1)"""


_RULES_SQL = " UNION ALL ".join([
    _rule_sql("IngestionStopped", "critical", "ingestion", _increase_rule_sql("click"), "value = 0", 120),
    _rule_sql("KafkaExporterDown", "critical", "monitoring", _UP_SQL, "value = 0", 30),
    _rule_sql("MinioStorageAlmostFull", "warning", "minio", _FULL_SQL, "value > 80", 300),
    _rule_sql("PrometheusRuleEvaluationFailures", "warning", "monitoring", _increase_rule_sql("error"), "value > 0", 60),
])


@query("alert_rules", _RULES_SQL)
def alert_rules(spark, sf):
    return evaluate_rules(metric_table(spark, sf), RULES).drop("labels")


# Samples in three stretches of time, the second applied twice, as after a failure.
@query("alert_rules_live", _RULES_SQL)
def alert_rules_live(spark, sf):
    live, samples = LiveAlerts(scratch_path(spark, "alerts")), metric_table(spark, sf)
    at = epoch_micros("ts")
    first, last = samples.agg(F.min(at), F.max(at)).first()
    third = (last - first) // 3 + 1
    for number in (0, 1, 1, 2):
        stretch = samples.where((at >= first + number * third) & (at < first + (number + 1) * third))
        apply_samples(stretch, number, live, last=number == 2)
    return live_episodes(spark, live).drop("labels")


@query("alert_history", """
WITH a AS (
  SELECT event_type AS alertname, CASE WHEN value > 100 THEN 'critical' ELSE 'warning' END AS severity,
         CAST(user_id AS VARCHAR) AS composant, CASE WHEN value > 10 THEN 'firing' ELSE 'resolved' END AS status FROM events
  UNION ALL SELECT 'any_event', 'info', CAST(user_id AS VARCHAR), 'firing' FROM events)
SELECT alertname, severity, composant, count(*) AS n_alerts, count(*) FILTER (status = 'firing') AS n_firing
FROM a GROUP BY 1, 2, 3
""")
def history(spark, sf):
    def alert(status, name, severity):
        labels = F.struct(name.alias("alertname"), severity.alias("severity"),
                          F.col("user_id").cast("string").alias("composant"))
        return F.struct(status.alias("status"), labels.alias("labels"))

    value = F.col("value")
    alerts = F.array(
        alert(F.when(value > 10, "firing").otherwise("resolved"), F.col("event_type"),
              F.when(value > 100, "critical").otherwise("warning")),
        alert(F.lit("firing"), F.lit("any_event"), F.lit("info")),
    )
    lines = table(spark, sf, "events").select(
        F.to_json(F.struct(F.col("ts").cast("string").alias("received_at"), F.struct(alerts.alias("alerts")).alias("payload")))
        .alias("value"))
    return alert_history(alert_log(lines))


# Cheap orders stand for partitions without a commit.
@query("consumer_lag", """
WITH p AS (SELECT o_custkey, o_orderstatus, o_orderpriority,
             CASE WHEN o_totalprice < 50000 THEN '-' ELSE CAST(CAST(floor(o_totalprice / 20000) AS BIGINT) AS VARCHAR) END AS lag
           FROM orders),
g AS (SELECT o_custkey, o_orderstatus, CAST(coalesce(sum(TRY_CAST(lag AS BIGINT)), 0) AS BIGINT) AS total_lag,
             count(DISTINCT o_orderpriority) AS n_partitions FROM p GROUP BY 1, 2)
SELECT *, CAST(greatest(1, least(ceil(total_lag / 20), least(5, n_partitions))) AS BIGINT) AS desired_workers FROM g
""")
def lag(spark, sf):
    text = F.when(F.col("o_totalprice") < 50000, "-").otherwise(
        F.floor(F.col("o_totalprice") / 20000).cast("bigint").cast("string"))
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", text.alias("lag"))
    return consumer_lag(rows, ["o_custkey", "o_orderstatus"], "lag", "o_orderpriority")
