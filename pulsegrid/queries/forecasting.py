"""Forecast scores and models on daily buckets of the events."""

from pyspark.sql import functions as F

from pulsegrid.functions import clip_low
from pulsegrid.operators import temporal_split
from pulsegrid.plans.forecast import (
    MINUTE, BoostedTrees, evaluate_horizons, fit_delta_trees, horizon_baselines, importances, scores, station_features,
    station_series, with_target,
)
from pulsegrid.plans.stations import FEATURES, HORIZONS
from pulsegrid.session import scratch_path

from .registry import events, query
from .timeseries import DAY, LAG_SQL, TARGET_SQL, lagged, targeted

def _scores_sql(test, prediction):
    return f"""SELECT * EXCLUDE (rmse_exact, rmse_b_exact), round((rmse_exact / nullif(rmse_b_exact, 0) - 1) * 100, 6) AS rmse_gain_pct FROM (
SELECT {_err('sqrt(avg((target - p) ^ 2))', test)} AS rmse_exact, {_err('sqrt(avg((target - value) ^ 2))', test)} AS rmse_b_exact,
  {_err('avg(abs(target - p))', test)} AS mae, round({_err('sqrt(avg((target - p) ^ 2))', test)}, 9) AS rmse,
  round(1 - {_err('sum((target - p) ^ 2)', test)} / ({_err('var_pop(target)', test)} * {_err('count(*)', test)}), 6) AS r2,
  {_err('avg(abs(target - value))', test)} AS mae_b, round({_err('sqrt(avg((target - value) ^ 2))', test)}, 9) AS rmse_b,
  count(*) FILTER (NOT ({test})) AS n_tr, count(*) FILTER ({test}) AS n_te
FROM (SELECT *, {prediction} AS p FROM marked))"""


def _err(expression, test):
    # every aggregate of the expression looks at test rows only
    for name in ("avg(", "sum(", "var_pop(", "count("):
        start = expression.find(name)
        if start < 0:
            continue
        depth, end = 0, start
        for end in range(start + len(name) - 1, len(expression)):
            depth += {"(": 1, ")": -1}.get(expression[end], 0)
            if depth == 0:
                break
        return f"{expression[:end + 1]} FILTER ({test}){expression[end + 1:]}"
    return expression


_MARKED = "marked AS (SELECT t.*, slot <= c AS is_train FROM targeted t, cut)"


def _tidy(df):
    return df.withColumns({c: F.round(c, 9) for c in ("rmse", "rmse_b")}).withColumns({c: F.round(c, 6) for c in ("r2", "rmse_gain_pct")})


@query("persistence_metrics", f"WITH {TARGET_SQL}, {_MARKED} {_scores_sql('NOT is_train', 'value')}")
def persistence_metrics(spark, sf):
    marked = temporal_split(targeted(spark, sf), "slot", 2 * DAY)
    return _tidy(scores(marked, "target", "value", "value"))


# A stand-in model that SQL can state as well: the first lag (the value where it is missing), never below zero.
@query("forecast_metrics", f"""
WITH {LAG_SQL},
targeted AS (SELECT s.user_id, s.slot, s.value, s.lag_1, t.value AS target FROM lagged s
  JOIN lagged t ON t.user_id = s.user_id AND t.slot = s.slot + INTERVAL '1 day'),
cut AS (SELECT max(slot) - INTERVAL '2 days' AS c FROM targeted), {_MARKED}
{_scores_sql('NOT is_train', 'greatest(coalesce(lag_1, value), 0)')}
""")
def forecast_metrics(spark, sf):
    ahead = with_target(lagged(spark, sf), ["user_id"], "slot", "value", DAY)
    marked = temporal_split(ahead, "slot", 2 * DAY).withColumn("p", clip_low(F.coalesce("lag_1", "value")))
    return _tidy(scores(marked, "target", "p", "value"))


def station_status(spark, sf):
    """Events as clean station status: a user is a station, the value its bikes, the counter its capacity."""
    bikes, capacity = F.round("value").cast("int"), F.col("k").cast("int")
    mechanical = F.floor(bikes * 0.7).cast("int")
    return events(spark, sf).select(
        F.col("user_id").cast("string").alias("stationcode"), bikes.alias("numbikesavailable"),
        clip_low(capacity - bikes).alias("numdocksavailable"), mechanical.alias("mechanical"), (bikes - mechanical).alias("ebike"),
        capacity.alias("capacity"), F.when(F.col("event_type") == "view", "Paris").otherwise(F.col("event_type")).alias(
            "nom_arrondissement_communes"), F.col("ts").alias("ingestion_ts"))


def _stored(frame, label):
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _features(spark, sf):
    """The published features; the series and they are written once to the shared folder: every use reads them."""
    series = _stored(station_series(station_status(spark, sf)), "series")
    return _stored(station_features(series), "forecast")


_SECONDS = {label: minutes * MINUTE for label, minutes in HORIZONS.items()}


@query("forecast_baselines", " UNION ALL ".join(f"""
SELECT '{label}' AS horizon, count(*) FILTER (slot <= c) AS n_tr, count(*) FILTER (slot > c) AS n_te,
  avg(abs(ahead - bikes)) FILTER (slot > c) AS mae_b, round(sqrt(avg((ahead - bikes) ^ 2) FILTER (slot > c)), 9) AS rmse_b
FROM (SELECT a.slot, a.bikes, b.bikes AS ahead, max(a.slot) OVER () - INTERVAL '2 days' AS c
      FROM slots a JOIN slots b ON a.user_id = b.user_id AND b.slot = a.slot + INTERVAL '{minutes} minutes')"""
    for label, minutes in HORIZONS.items()).join(["""
WITH once AS (SELECT user_id, ts, min(round(CAST(value AS DECIMAL(12,2)))) AS bikes FROM events GROUP BY user_id, ts),
slots AS (SELECT user_id, time_bucket(INTERVAL '15 minutes', ts) AS slot, CAST(round_even(avg(CAST(bikes AS DOUBLE)), 0) AS BIGINT) AS bikes
          FROM once GROUP BY user_id, slot)
""", ""]))
def forecast_baselines(spark, sf):
    """What the trees of :func:`forecast_gbt` are measured against: set sizes and persistence for each horizon."""
    out = horizon_baselines(_features(spark, sf), _KEYS, _TS, _BIKES, _SECONDS)
    return out.withColumn("rmse_b", F.round("rmse_b", 9))


@query("forecast_gbt")
def forecast_gbt(spark, sf, settings=BoostedTrees()):
    return evaluate_horizons(_features(spark, sf), _KEYS, _TS, _BIKES, FEATURES, _SECONDS, settings=settings)


@query("feature_importance")
def feature_importance(spark, sf, settings=BoostedTrees()):
    ahead = _stored(with_target(_features(spark, sf), _KEYS, _TS, _BIKES, HORIZONS["H+1"] * MINUTE), "ahead")
    train = temporal_split(ahead, _TS, 2 * DAY).where(F.col("split") == "train")
    return importances(fit_delta_trees(train, FEATURES, _BIKES, "target", settings), FEATURES, spark)


_KEYS, _TS, _BIKES = ["stationcode"], "ts_15min", "numbikesavailable"
