"""Rules kept up batch by batch against their evaluation over all samples."""

import datetime as dt
import random

import pytest

from pulsegrid.plans.alerts import RULES, evaluate_rules
from pulsegrid.streaming import LiveAlerts, apply_samples, late_samples, live_episodes

T0 = dt.datetime(2026, 3, 2, 8)
SAMPLE = "ts timestamp_ntz, metric string, labels map<string, string>, value double"
SERVICE = "container_label_com_docker_compose_service"
# Every metric of the rules with labels that its rule asks for.
SERIES = [
    ("kafka_topic_partition_current_offset", {"topic": "station_status", "partition": "0"}),
    ("kafka_topic_partition_current_offset", {"topic": "station_status", "partition": "1"}),
    *[("up", {"job": job, "instance": "a"}) for job in ("kafka", "minio-cluster", "cadvisor", "alertmanager")],
    ("kafka_brokers", {"instance": "a"}), ("minio_cluster_nodes_offline_total", {"server": "x"}),
    ("minio_cluster_usage_total_bytes", {"server": "x"}), ("minio_cluster_capacity_usable_total_bytes", {"server": "x"}),
    ("minio_cluster_drive_offline_total", {"server": "x"}), ("container_cpu_usage_seconds_total", {"job": "cadvisor", SERVICE: "spark", "cpu": "0"}),
    ("container_cpu_usage_seconds_total", {"job": "cadvisor", SERVICE: "spark", "cpu": "1"}),
    ("container_memory_working_set_bytes", {"job": "cadvisor", SERVICE: "spark"}),
    ("prometheus_rule_evaluation_failures_total", {"instance": "p", "rule_group": "g"}), ("something_else", {"x": "y"}),
]


def scraped(seed, n):
    """One sample of every series each 30 seconds (some missing); values stay for a while and then change."""
    draw, rows = random.Random(seed), []
    state = [0.0] * len(SERIES)
    for i in range(n):
        for at, (metric, labels) in enumerate(SERIES):
            if draw.random() < 0.15:
                if metric.endswith(("offset", "seconds_total", "failures_total")):
                    state[at] = 0.0 if draw.random() < 0.1 else state[at] + draw.choice([1, 40, 90])
                elif "bytes" in metric:
                    state[at] = float(draw.choice([1, 9, 10, 2_000_000_000]))
                else:
                    state[at] = float(draw.randint(0, 1))
            if draw.random() > 0.1:
                rows.append((T0 + dt.timedelta(seconds=30 * i), metric, labels, state[at]))
    return rows


def plain(frame):
    return sorted((r["alertname"], sorted(r["labels"].items()), r["started_at"], r["last_true"], str(r["resolved_at"]), r["state"])
                  for r in frame.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_whole_history(spark, tmp_path, seed):
    rows, draw = scraped(seed, 60), random.Random(seed)
    expected = plain(evaluate_rules(spark.createDataFrame(rows, SAMPLE)))
    assert len({name for name, *_ in expected}) >= 10
    # up to 50 seconds late, dealt to batches by the time of arrival
    arrivals = sorted(((r[0] + dt.timedelta(seconds=draw.randint(0, 50)), i) for i, r in enumerate(rows)))
    cuts = [0, *sorted(draw.sample(range(1, len(rows)), 3)), len(rows)]
    live = LiveAlerts(str(tmp_path), delay_seconds=60)
    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
        batch = spark.createDataFrame([rows[i] for _, i in arrivals[a:b]], SAMPLE)
        for _ in range(2 if number == 1 else 1):                    # run again after a failure
            apply_samples(batch, number, live, last=b == len(rows))
    assert late_samples(spark, live).count() == 0
    assert plain(live_episodes(spark, live)) == expected


def test_late_samples_are_kept_apart(spark, tmp_path):
    live = LiveAlerts(str(tmp_path), rules=[r for r in RULES if r.name == "KafkaBrokerDown"], delay_seconds=0)

    def at(seconds, value):
        return (None if seconds is None else T0 + dt.timedelta(seconds=seconds), "kafka_brokers", {"instance": "a"}, value)

    apply_samples(spark.createDataFrame([at(0, 0.0), at(30, 0.0)], SAMPLE), 0, live)
    assert [r["state"] for r in live_episodes(spark, live).collect()] == ["FIRING"]
    apply_samples(spark.createDataFrame([at(15, 3.0), at(None, 1.0)], SAMPLE), 1, live)
    assert [r["state"] for r in live_episodes(spark, live).collect()] == ["FIRING"]
    assert late_samples(spark, live).count() == 2
    apply_samples(spark.createDataFrame([], SAMPLE), 2, live)
    apply_samples(spark.createDataFrame([at(60, 3.0)], SAMPLE), 3, live)
    found = live_episodes(spark, live).collect()
    assert [(r["state"], r["started_at"], r["last_true"], r["resolved_at"]) for r in found] == [
        ("RESOLVED", T0, T0 + dt.timedelta(seconds=30), T0 + dt.timedelta(seconds=60))]
