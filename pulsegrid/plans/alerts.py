"""The standing alert rules over a metric table ``(ts, metric, labels MAP<STRING,STRING>, value)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.operators.metrics import alert_episodes, counter_increase, gauge_ratio
from pulsegrid.operators.neighbours import HOUR


@dataclass(frozen=True)
class AlertRule:
    """``shape`` is one of increase, rate, gauge, ratio; ``test`` compares with ``threshold``."""

    name: str
    shape: str
    metric: str
    test: str
    threshold: float
    hold_seconds: int
    severity: str
    component: str
    by: Sequence[str] = ()                       # labels that stay apart
    where: Mapping[str, str] = field(default_factory=dict)
    present: Sequence[str] = ()                  # labels that must be non-empty
    fold: str = "max"                            # how series of one group combine
    window_seconds: int = 0
    scale: float = 1.0
    metric_of: str = ""                          # denominator of a ratio


def standing_rules(topic: str = "station_status") -> list[AlertRule]:
    """The twelve rules; ingestion counts as stopped when ``topic`` stands still, other topics are slower."""
    return [rule if rule.name != "IngestionStopped" else replace(rule, where={"topic": topic}) for rule in _RULES]


# The twelve alert rules (metric, comparison, hold time, severity, component).
_RULES = [
    AlertRule("IngestionStopped", "increase", "kafka_topic_partition_current_offset", "==", 0, 120, "critical",
              "ingestion", by=("topic",), fold="sum", window_seconds=300),
    AlertRule("KafkaExporterDown", "gauge", "up", "==", 0, 30, "critical", "monitoring",
              by=("job", "instance"), where={"job": "kafka"}),
    AlertRule("KafkaBrokerDown", "gauge", "kafka_brokers", "<", 1, 30, "critical", "kafka", by=("instance",)),
    AlertRule("MinioDown", "gauge", "up", "==", 0, 30, "critical", "minio",
              by=("job", "instance"), where={"job": "minio-cluster"}),
    AlertRule("MinioNodeOffline", "gauge", "minio_cluster_nodes_offline_total", ">", 0, 60, "critical", "minio"),
    AlertRule("MinioStorageAlmostFull", "ratio", "minio_cluster_usage_total_bytes", ">", 80, 300, "warning", "minio",
              metric_of="minio_cluster_capacity_usable_total_bytes"),
    AlertRule("MinioDriveOffline", "gauge", "minio_cluster_drive_offline_total", ">", 0, 60, "critical", "minio"),
    AlertRule("CadvisorDown", "gauge", "up", "==", 0, 30, "critical", "ressources",
              by=("job", "instance"), where={"job": "cadvisor"}),
    AlertRule("ContainerHighCPU", "rate", "container_cpu_usage_seconds_total", ">", 85, 180, "warning", "ressources",
              by=("container_label_com_docker_compose_service",), where={"job": "cadvisor"},
              present=("container_label_com_docker_compose_service",), fold="sum", window_seconds=120, scale=100),
    AlertRule("ContainerHighMemory", "gauge", "container_memory_working_set_bytes", ">", 1610612736, 300, "warning",
              "ressources", by=("container_label_com_docker_compose_service",), where={"job": "cadvisor"},
              present=("container_label_com_docker_compose_service",), fold="sum"),
    AlertRule("AlertmanagerDown", "gauge", "up", "==", 0, 30, "critical", "monitoring",
              by=("job", "instance"), where={"job": "alertmanager"}),
    AlertRule("PrometheusRuleEvaluationFailures", "increase", "prometheus_rule_evaluation_failures_total", ">", 0, 60, "warning",
              "monitoring", by=("instance", "rule_group"), window_seconds=300),
]

RULES = standing_rules()

# Rules are data, so the expressions over them are put together as SQL text: one expression per
# plan step instead of one call per rule and operator.


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(_text(v) for v in values)})" if values else "false"


def _entries(labels: str) -> str:
    """A label map in comparable form: its entries sorted by name."""
    return f"array_sort(map_entries({labels}))"


def _applies(rule: AlertRule) -> str:
    tests = [_one_of("metric", [m for m in (rule.metric, rule.metric_of) if m])]
    tests += [f"labels[{_text(label)}] = {_text(value)}" for label, value in rule.where.items()]
    tests += [f"coalesce(labels[{_text(label)}], '') <> ''" for label in rule.present]
    return " AND ".join(tests)


def _hit(rule: AlertRule) -> str:
    group = _entries(f"map_filter(labels, (name, value) -> {_one_of('name', rule.by)})")
    return f"CASE WHEN {_applies(rule)} THEN struct({_text(rule.name)} AS rule, {group} AS group) END"


def _matched(metrics: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Samples with the rule that looks at them; a sample used by two rules appears twice.

    One scan serves all the rules, and only their metrics are read from it.
    """
    wanted = sorted({m for r in rules for m in (r.metric, r.metric_of) if m})
    hits = F.expr(f"explode(array_compact(array({', '.join(_hit(r) for r in rules)})))")
    return (
        metrics.where(F.expr(_one_of("metric", wanted)))
        .select("ts", "metric", "labels", "value", hits.alias("_hit"))
        .select("ts", "metric", "labels", "value", "_hit.rule", "_hit.group")
    )


def _per_rule(rules: Sequence[AlertRule], pick: Callable[[AlertRule], str]) -> Column:
    """A column that depends on the row's rule."""
    return F.expr(f"CASE rule {' '.join(f'WHEN {_text(r.name)} THEN {pick(r)}' for r in rules)} END")


def _folded(rows: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Combine the series of a group at each time, by sum or maximum as the rule says."""
    both = rows.groupBy("rule", "group", "ts").agg(F.sum("value").alias("sum"), F.max("value").alias("max"))
    return both.select("rule", "group", "ts", _per_rule(rules, lambda r: r.fold).alias("value"))


def _counter_values(metrics: DataFrame, rules: Sequence[AlertRule], window: int, chunk_seconds: int) -> DataFrame:
    rows = _matched(metrics, rules).select("rule", "group", "ts", "value", F.expr(_entries("labels")).alias("series"))
    grown = counter_increase(rows, ["rule", "group", "series"], "ts", "value", window, name="grown",
                             chunk_seconds=chunk_seconds)
    shown = _per_rule(rules, lambda r: f"grown * {float(r.scale)}D / {window if r.shape == 'rate' else 1}")
    return _folded(grown.withColumn("value", shown), rules)


def rule_values(metrics: DataFrame, rules: Sequence[AlertRule] = RULES, chunk_seconds: int = HOUR) -> DataFrame:
    """What the rules look at: ``rule``, ``group`` (label entries), ``ts``, ``value``.

    Rules of one shape share a plan: one for gauges, one per counter window, one per ratio.
    """
    parts = []
    gauges = [r for r in rules if r.shape == "gauge"]
    if gauges:
        parts.append(_folded(_matched(metrics, gauges), gauges))
    counters = [r for r in rules if r.shape in ("increase", "rate")]
    for window in sorted({r.window_seconds for r in counters}):
        parts.append(_counter_values(metrics, [r for r in counters if r.window_seconds == window], window, chunk_seconds))
    for r in rules:
        if r.shape == "ratio":
            at = [F.col(c) for c in ("rule", "group", "ts")]
            ratios = gauge_ratio(_matched(metrics, [r]), at, "metric", "value", r.metric, r.metric_of)
            parts.append(ratios.select("rule", "group", "ts", F.col("ratio").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def evaluate_rules(metrics: DataFrame, rules: Sequence[AlertRule] = RULES, chunk_seconds: int = HOUR) -> DataFrame:
    """Episodes of every rule over the whole metric table."""
    values = rule_values(metrics, rules, chunk_seconds)
    return described(rule_episodes(values, rules, chunk_seconds), rules)


def breached(rules: Sequence[AlertRule]) -> Column:
    """Whether a row of :func:`rule_values` breaks its rule."""
    return _per_rule(rules, lambda r: f"value {r.test} {float(r.threshold)}D")


def rule_episodes(values: DataFrame, rules: Sequence[AlertRule] = RULES, chunk_seconds: int = HOUR,
                  broken: Column | None = None) -> DataFrame:
    """Episodes by ``rule`` and ``group``; ``broken`` replaces the rules' own test."""
    hold = _per_rule(rules, lambda r: str(r.hold_seconds))
    return alert_episodes(values, ["rule", "group"], "ts", breached(rules) if broken is None else broken, hold,
                          chunk_seconds=chunk_seconds)


def described(episodes: DataFrame, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    """Episodes as alerts: name, severity, component and labels."""
    return episodes.select(
        F.col("rule").alias("alertname"),
        _per_rule(rules, lambda r: _text(r.severity)).alias("severity"),
        _per_rule(rules, lambda r: _text(r.component)).alias("composant"),
        F.map_from_entries("group").alias("labels"),
        "started_at", "last_true", "resolved_at", "state",
    )


def counter_metrics(rules: Sequence[AlertRule] = RULES) -> list[str]:
    return sorted({r.metric for r in rules if r.shape in ("increase", "rate")})


def series_key(labels: str = "labels") -> Column:
    """A label map in a form that can be compared."""
    return F.expr(_entries(labels))


def firing_count(episodes: DataFrame) -> DataFrame:
    """Currently firing alerts, grouped the way notifications are."""
    return (
        episodes.where(F.col("state") == "FIRING")
        .groupBy("alertname", "severity", "composant").agg(F.count(F.lit(1)).alias("n_firing"))
    )
