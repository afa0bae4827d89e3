import datetime as dt
import math

from pyspark.sql import functions as F

from pulsegrid.plans.clusters import cluster_entities, profile_columns
from pulsegrid.operators import cluster_summary, hourly_profile
from pulsegrid.plans.forecast import (
    BoostedTrees, _few_partitions, evaluate_horizons, fit_delta_trees, importances, predict, scores, station_features, station_rates,
    station_series,
)
from pulsegrid.plans.stations import FEATURES, HORIZONS


def test_trees_learn_a_change_the_baseline_cannot(spark):
    base = spark.range(600).select(
        (F.col("id") % 20).cast("double").alias("value"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 7).cast("double")).alias("lag"))
    # where the lag is missing the value falls to nothing
    data = base.withColumn("target", F.when(F.col("lag").isNull(), 0.0).otherwise(F.col("value") + F.col("lag")))
    model = fit_delta_trees(data, ["value", "lag"], "value", "target", BoostedTrees(trees=15, step=0.3))
    out = predict(model, data.withColumn("split", F.lit("test")), ["value", "lag"], "value")
    assert out.where("prediction < 0").count() == 0
    s = scores(out, "target", "prediction", "value").head()
    assert s["rmse"] < 0.6 * s["rmse_b"] and s["n_te"] == 600 and s["r2"] > 0.5 and s["rmse_gain_pct"] < 0
    weights = {r["feature"]: r["importance"] for r in importances(model, ["value", "lag"], spark).collect()}
    assert math.isclose(sum(weights.values()), 1.0, abs_tol=1e-6) and weights["lag"] > 0


def test_station_history_to_scores_and_clusters(spark):
    t0 = dt.datetime(2026, 3, 2)
    rows = []
    for s in range(6):
        for i in range(4 * 24 * 5):
            bikes = 10 + (8 if (i // 48 + s) % 2 else -8)
            ts = t0 + dt.timedelta(minutes=15 * i, seconds=30)
            rows += [(f"s{s}", bikes, 20 - bikes, bikes, 0, 20 if s else None, "Paris", ts)] * (2 if i % 50 == 0 else 1)
    status = spark.createDataFrame(rows, "stationcode STRING, numbikesavailable INT, numdocksavailable INT, mechanical INT, "
                                         "ebike INT, capacity INT, nom_arrondissement_communes STRING, ingestion_ts TIMESTAMP")
    series = station_series(status)
    assert series.count() == 6 * 480
    features = station_features(series)
    out = evaluate_horizons(features, ["stationcode"], "ts_15min", "numbikesavailable", FEATURES,
                            {"H+1": HORIZONS["H+1"] * 60}, settings=BoostedTrees(trees=3, step=0.3)).head()
    assert out["horizon"] == "H+1" and out["n_te"] == 6 * 192 and out["n_tr"] == 6 * (480 - 4 - 192)
    profiles = hourly_profile(station_rates(series), "stationcode", "ts_15min", "taux_occ")
    labels = cluster_entities(profiles, "stationcode", k=2, restarts=2)
    groups = {r["stationcode"]: r["cluster"] for r in labels.collect()}
    assert len({groups[f"s{i}"] for i in (0, 2, 4)}) == 1 and groups["s0"] != groups["s1"]
    summary = cluster_summary(station_rates(series), labels, "stationcode", "taux_occ", "capacity")
    assert {r["n_entities"] for r in summary.collect()} == {3}


def test_published_settings_are_the_default():
    s = BoostedTrees()
    assert (s.trees, s.depth, s.step, s.row_share, s.column_share, s.min_rows, s.seed) == (400, 6, 0.05, 0.8, 0.8, 5, 42)


def test_clusters_separate_clear_groups(spark):
    rows = []
    for i in range(40):
        level = i % 4
        rows.append((f"e{i}", *[float(level * (10 if h < 12 else -10) + 0.01 * i) for h in range(24)]))
    df = spark.createDataFrame(rows, "key STRING, " + ", ".join(f"{c} DOUBLE" for c in profile_columns()))
    labels = {r["key"]: r["cluster"] for r in cluster_entities(df, "key", k=4, restarts=3).collect()}
    groups = [{labels[f"e{i}"] for i in range(40) if i % 4 == g} for g in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4


def test_restarts_run_in_few_tasks(spark):
    rows = [(f"e{i}", *[float((i % 4) * (10 if h < 12 else -10) + 0.01 * i) for h in range(24)]) for i in range(40)]
    df = spark.createDataFrame(rows, "key STRING, " + ", ".join(f"{c} DOUBLE" for c in profile_columns())).repartition(80)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("restarts", "")
    try:
        labels = cluster_entities(df, "key", k=4, restarts=3)
    finally:
        context._jsc.clearJobGroup()
    stages = [s for job in tracker.getJobIdsForGroup("restarts") for s in tracker.getJobInfo(job).stageIds]
    tasks = [found.numTasks for s in stages if (found := tracker.getStageInfo(s))]
    assert len(tasks) > 12 and sorted(tasks)[len(tasks) // 2] <= 16      # 80 in each stage of a run, before
    assert labels.inputFiles() and "Aggregate" not in labels._jdf.queryExecution().optimizedPlan().toString()


def test_training_rows_use_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(200_000, numPartitions=1)     # in one partition, before
    assert _few_partitions(rows, 200_000).rdd.getNumPartitions() == min(10, cores)
    assert _few_partitions(rows, 10**9).rdd.getNumPartitions() == cores
    assert _few_partitions(spark.range(100, numPartitions=8), 100).rdd.getNumPartitions() == 1


def test_registered_models_are_the_published_ones(spark):
    import inspect

    from pulsegrid.queries import QUERIES

    for name in ("forecast_gbt", "feature_importance"):
        assert inspect.signature(QUERIES[name]).parameters["settings"].default == BoostedTrees()
    few = BoostedTrees(trees=1)
    rows = {r["horizon"]: r for r in QUERIES["forecast_gbt"](spark, "/root/testdata/sf0.01", few).collect()}
    assert set(rows) == set(HORIZONS) and all(r["n_tr"] > 0 and r["n_te"] > 0 for r in rows.values())
    weights = QUERIES["feature_importance"](spark, "/root/testdata/sf0.01", few).collect()
    assert {r["feature"] for r in weights} == set(FEATURES)
