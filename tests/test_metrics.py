import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.operators import alert_episodes, consumer_lag, counter_increase, counter_rate, gauge_ratio, stalls
from pulsegrid.plans.alerts import RULES, evaluate_rules, firing_count
from pulsegrid.sources import alert_log
from pulsegrid.operators import alert_history, delivery_audit, manifest_diff, recovery_point

T0 = dt.datetime(2026, 3, 2)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_counter_restart_counts_from_zero(spark, rows):
    df = spark.createDataFrame([("a", at(0), 10), ("a", at(60), 15), ("a", at(120), 2), ("a", at(400), 4)],
                               "s STRING, ts TIMESTAMP, v BIGINT")
    got = rows(counter_increase(df, ["s"], "ts", "v", 300, chunk_seconds=60), "ts", "increase")
    assert got == [(at(0), 0), (at(60), 5), (at(120), 7), (at(400), 4)]
    assert rows(counter_rate(df, ["s"], "ts", "v", 10), "rate")[-1] == (0.5,)


def test_alert_needs_the_hold_time(spark, rows):
    def series(name, flags):
        return [(name, at(30 * i), bool(f)) for i, f in enumerate(flags)]

    data = series("short", [0, 1, 1, 0, 0]) + series("fired", [1, 1, 1, 1, 0, 1]) + series("open", [0, 0, 1, 1, 1, 1])
    df = spark.createDataFrame(data, "s STRING, ts TIMESTAMP, bad BOOLEAN")
    for chunk in (60, 86400):
        got = rows(alert_episodes(df, ["s"], "ts", F.col("bad"), 60, chunk_seconds=chunk))
        assert got == [
            ("fired", at(0), at(90), at(120), "RESOLVED"),
            ("fired", at(150), at(150), None, "PENDING"),
            ("open", at(60), at(150), None, "FIRING"),
            ("short", at(30), at(60), at(90), "PENDING"),
        ]


def test_ratio_of_missing_or_zero_capacity_is_not_an_alert(spark, rows):
    df = spark.createDataFrame([(1, "used", 9.0), (1, "cap", 10.0), (2, "used", 5.0), (3, "used", 1.0), (3, "cap", 0.0)],
                               "t INT, m STRING, v DOUBLE")
    got = rows(gauge_ratio(df, [F.col("t")], "m", "v", "used", "cap"), "t", "ratio", "is_over")
    assert got == [(1, 90.0, True), (2, None, False), (3, None, False)]


def test_lag_leaves_out_dashes(spark, rows):
    df = spark.createDataFrame(
        [("g", "t", p, lag) for p, lag in enumerate(["300", "-", "0", "5", "1"])] + [("h", "t", 0, "-"), ("i", "t", 0, "400")],
        "grp STRING, topic STRING, p INT, lag STRING")
    got = rows(consumer_lag(df, ["grp", "topic"], "lag", "p"))
    assert got == [("g", "t", 306, 5, 5), ("h", "t", 0, 1, 1), ("i", "t", 400, 1, 1)]


def test_stall(spark, rows):
    df = spark.createDataFrame([("q", at(0)), ("q", at(30)), ("q", at(7230))], "q STRING, ts TIMESTAMP")
    assert rows(stalls(df, ["q"], "ts", 2100)) == [("q", at(30), at(7230), 7200.0)]


def _samples(rule, value, seconds, labels=None):
    labels = dict({name: f"{name}-x" for name in rule.by}, **dict(rule.where), **(labels or {}))
    return [(at(s), rule.metric, labels, float(value(s))) for s in range(0, seconds, 15)]


def test_each_of_the_twelve_rules_fires(spark):
    assert len(RULES) == 12
    data = []
    for r in RULES:
        if r.shape == "gauge":
            value = {"==": 0, "<": 0, ">": r.threshold + 1}[r.test]
            data += _samples(r, lambda s, v=value: v, 900)
        elif r.shape == "ratio":
            data += _samples(r, lambda s: 90, 900)
            data += [(t, r.metric_of, labels, 100.0) for t, _, labels, _ in _samples(r, lambda s: 0, 900)]
        elif r.test == "==":
            data += _samples(r, lambda s: 7, 900)                 # offset stands still
        else:
            data += _samples(r, lambda s: 2 * s, 900)             # grows all the time: 200 % CPU
    metrics = spark.createDataFrame(data, "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, value DOUBLE")
    got = evaluate_rules(metrics).collect()
    assert {(r["alertname"], r["state"]) for r in got} == {(r.name, "FIRING") for r in RULES}
    cpu = next(r for r in got if r["alertname"] == "ContainerHighCPU")
    assert cpu["labels"] == {"container_label_com_docker_compose_service": "container_label_com_docker_compose_service-x"}
    assert (cpu["severity"], cpu["composant"]) == ("warning", "ressources")
    assert sum(r["n_firing"] for r in firing_count(evaluate_rules(metrics)).collect()) == 12


def test_quiet_metrics_raise_nothing(spark):
    up = next(r for r in RULES if r.name == "KafkaExporterDown")
    metrics = spark.createDataFrame(_samples(up, lambda s: 1, 300), "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, value DOUBLE")
    assert evaluate_rules(metrics).count() == 0


def test_alert_log_lines(spark, rows):
    line = ('{"received_at":"2026-03-02T00:00:00+00:00","payload":{"alerts":[{"status":"firing","labels":{"alertname":"A",'
            '"severity":"critical","composant":"x"}},{"status":"resolved","labels":{"alertname":"A","severity":"critical","composant":"x"}}]}}')
    lines = spark.createDataFrame([(line,), ("not json",), ('{"payload":{}}',)], "value STRING")
    alerts = alert_log(lines)
    assert alerts.head()["received_at"] == T0
    assert rows(alert_history(alerts)) == [("A", "critical", "x", 2, 1)]


def test_delivery_audit_counts(spark):
    sent = spark.createDataFrame([(f"m{i}",) for i in range(120)], "m STRING")
    same = delivery_audit(sent, sent.repartition(7), "m").head()
    assert (same["expected_count"], same["consumed_count"], same["unique_consumed_count"], same["intact"]) == (120, 120, 120, True)
    received = spark.createDataFrame([(f"m{i}",) for i in range(119)] + [("m0",), ("zz",)], "m STRING")
    bad = delivery_audit(sent, received, "m").head()
    assert (bad["missing_count"], bad["unexpected_count"], bad["duplicated_count"], bad["intact"]) == (1, 1, 1, False)


def test_manifest_states_and_recovery_point(spark, rows):
    columns = "path STRING, checksum STRING, n_rows BIGINT"
    a = spark.createDataFrame([("raw/x", "1", 10), ("clean/x", "2", 20), ("curated/x", "3", 30)], columns)
    b = spark.createDataFrame([("raw/x", "1", 10), ("clean/x", "9", 20), ("new", "4", 1)], columns)
    diff = manifest_diff(a, b)
    assert dict(rows(diff, "path", "state")) == {"raw/x": "same", "clean/x": "changed", "curated/x": "missing", "new": "unexpected"}
    assert tuple(recovery_point(diff).head()) == (3, 1, 2, 50)
