"""Short-term forecast: feature table, persistence baseline, boosted trees and their scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions import calendar_parts, clip_low, regression_scores, row_mean, share_of
from pulsegrid.operators.latest import first_per_key
from pulsegrid.operators.median import fill_with_median, median_of
from pulsegrid.operators.series import bucket_series, offset_lookup, shift
from pulsegrid.session import ensure_checkpoint_dir, scratch_path

from .stations import FEATURES, LAGS

MINUTE = 60
TWO_DAYS = 2 * 86_400
ROWS_PER_TASK = 20_000  # of a training table, while there are free cores
_VECTOR = "_features"


def lag_features(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, lags: Mapping[str, int],
    mean_name: str = "roll_mean_lag",
) -> DataFrame:
    """Exact-offset lags (seconds, given as positive numbers) and their mean over present ones."""
    looked = offset_lookup(series, keys, ts, value, {name: -abs(s) for name, s in lags.items()})
    return looked.withColumn(mean_name, row_mean(*lags))


def with_target(
    series: DataFrame, keys: Sequence[str], ts: str, value: str, horizon_seconds: int, name: str = "target"
) -> DataFrame:
    """Value one horizon ahead; rows without it are left out."""
    # stated up front, so that both sides of the look-up filter alike and share their exchange
    for column in (*keys, ts):
        series = series.where(F.col(column).isNotNull())
    return offset_lookup(series, keys, ts, value, {name: horizon_seconds}).where(F.col(name).isNotNull())


def station_series(status: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Clean status rows as a regular series: repeats removed, one row per station and time slot."""
    measures = ["numbikesavailable", "numdocksavailable", "mechanical", "ebike"]
    order = [*measures, "capacity", "nom_arrondissement_communes"]
    unique = first_per_key(status.where(F.col("stationcode").isNotNull()), ["stationcode", "ingestion_ts"], order)
    return bucket_series(unique, ["stationcode"], "ingestion_ts", width, maxima=["capacity"],
                         firsts=["nom_arrondissement_communes"], means=measures, bucket="ts_15min")


def station_rates(series: DataFrame) -> DataFrame:
    """Series with missing capacities filled and the occupancy as a fraction, for daily profiles."""
    return fill_with_median(series, "capacity").withColumn("taux_occ", share_of("numbikesavailable", "capacity"))


def station_features(series: DataFrame, keys: Sequence[str] = ("stationcode",), ts: str = "ts_15min") -> DataFrame:
    """The 17 feature columns of a 15-minute station series."""
    lags = {f"lag_{m}": m * MINUTE for m in LAGS}
    out = lag_features(series, keys, ts, "numbikesavailable", lags)
    return (
        out.withColumns(calendar_parts(ts))
        .withColumn("capacity", F.coalesce(F.col("capacity").cast("double"), median_of(series, "capacity")))
        .withColumn("taux_occ", share_of("numbikesavailable", "capacity"))
        .withColumn("is_paris", F.col("nom_arrondissement_communes").eqNullSafe(F.lit("Paris")).cast("int"))
        .select(*keys, ts, *FEATURES)
    )


def score_columns(actual: str, predicted: str, baseline: str, split: str = "split") -> dict[str, Column]:
    """MAE, RMSE, R2 of a prediction and MAE, RMSE of a baseline on test rows, set sizes and the RMSE gain in
    percent, as aggregates.  Rows whose split is NULL take no part."""
    test = F.col(split) == "test"

    def only_test(column: str):
        return F.when(test, F.col(column))

    model = regression_scores(only_test(actual), only_test(predicted))
    base = regression_scores(only_test(actual), only_test(baseline))
    return {
        "mae": model["mae"], "rmse": model["rmse"], "r2": model["r2"], "mae_b": base["mae"], "rmse_b": base["rmse"],
        "n_tr": F.count_if(~test), "n_te": F.count_if(test),
        "rmse_gain_pct": (F.try_divide(model["rmse"], base["rmse"]) - 1) * 100,
    }


def scores(df: DataFrame, actual: str, predicted: str, baseline: str, split: str = "split") -> DataFrame:
    """:func:`score_columns` as one row."""
    return df.agg(*[c.alias(name) for name, c in score_columns(actual, predicted, baseline, split).items()])


@dataclass(frozen=True)
class BoostedTrees:
    """Settings of the published model, mapped to Spark's parameters."""

    trees: int = 400
    depth: int = 6
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 5
    seed: int = 42


def _usable(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    # trees cannot read NULL: a constant takes its place and an indicator of its own tells it from a value
    columns = {}
    for name in features:
        value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        columns[f"f_{name}"] = F.coalesce(value, F.lit(-1.0))
        columns[f"f_{name}_missing"] = value.isNull().cast("double")
    return df.withColumns(columns), list(columns)


def _trees(settings: BoostedTrees, label: str, prediction: str) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=_VECTOR, labelCol=label, predictionCol=prediction,
        maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.step,
        subsamplingRate=settings.row_share, featureSubsetStrategy=str(settings.column_share),
        minInstancesPerNode=settings.min_rows, seed=settings.seed,
        cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=512,
    )


def _few_partitions(df: DataFrame, rows: int) -> DataFrame:
    """Training rows in as few partitions as their number needs, a core's each at most: every level of every tree is a
    job over all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    needed = max(1, min(-(-rows // ROWS_PER_TASK), cores))
    return df.coalesce(1) if needed == 1 else df.repartition(needed)


def fit_delta_trees(
    train: DataFrame, features: Sequence[str], current: str, target: str, settings: BoostedTrees = BoostedTrees()
) -> PipelineModel:
    """Boosted trees on the change from the current value to the target."""
    ensure_checkpoint_dir(train.sparkSession)
    usable, inputs = _usable(train, features)
    usable = usable.withColumn("_delta", (F.col(target) - F.col(current)).cast("double")).select(*inputs, "_delta")
    usable = usable.persist()
    try:
        stages = [VectorAssembler(inputCols=inputs, outputCol=_VECTOR), _trees(settings, "_delta", "_delta_hat")]
        return Pipeline(stages=stages).fit(_few_partitions(usable, usable.count()))
    finally:
        usable.unpersist()


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str], current: str, name: str = "prediction") -> DataFrame:
    """Current value plus predicted change, never below zero."""
    usable, inputs = _usable(df, features)
    out = model.transform(usable)
    forecast = clip_low(F.col(current).cast("double") + F.col("_delta_hat"))
    return out.withColumn(name, forecast).drop(*inputs, _VECTOR, "_delta_hat")


def horizon_targets(
    features: DataFrame, keys: Sequence[str], ts: str, current: str, horizons: Mapping[str, int],
    holdout_seconds: int = TWO_DAYS,
) -> DataFrame:
    """``features`` with target_0, split_0, ... for each horizon in turn, from one look-up.

    A row without a target ahead has no split for that horizon; the cut of a horizon is its newest row that has
    one, less the hold-out.
    """
    return _with_splits(_with_targets(features, keys, ts, current, horizons), ts, horizons, holdout_seconds)


def _with_targets(features: DataFrame, keys: Sequence[str], ts: str, current: str, horizons: Mapping[str, int]) -> DataFrame:
    for column in (*keys, ts):
        features = features.where(F.col(column).isNotNull())
    return offset_lookup(features, keys, ts, current, {f"target_{i}": seconds for i, seconds in enumerate(horizons.values())})


def _with_splits(ahead: DataFrame, ts: str, horizons: Mapping[str, int], holdout_seconds: int) -> DataFrame:
    names = [f"target_{i}" for i in range(len(horizons))]
    cuts = ahead.agg(F.struct(*[shift(F.max(F.when(F.col(t).isNotNull(), F.col(ts))), -holdout_seconds).alias(t)
                                for t in names]).alias("cuts")).scalar()
    ahead = ahead.withColumn("_cuts", cuts)
    return ahead.withColumns({f"split_{i}": F.when(F.col(t).isNotNull(), F.when(F.col(ts) <= F.col(f"_cuts.{t}"), "train").otherwise("test"))
                              for i, t in enumerate(names)}).drop("_cuts")


def horizon_baselines(
    features: DataFrame, keys: Sequence[str], ts: str, current: str, horizons: Mapping[str, int], holdout_seconds: int = TWO_DAYS,
) -> DataFrame:
    """Set sizes and the scores of persistence for each horizon, one row each."""
    table = horizon_targets(features, keys, ts, current, horizons, holdout_seconds)
    return _per_horizon(table, horizons, lambda i: score_columns(f"target_{i}", current, current, f"split_{i}")).select(
        "horizon", "n_tr", "n_te", "mae_b", "rmse_b")


def _per_horizon(table: DataFrame, horizons: Mapping[str, int], measures) -> DataFrame:
    """One aggregation over the table, one row per horizon."""
    rows = [F.struct(F.lit(label).alias("horizon"), *[c.alias(name) for name, c in measures(i).items()])
            for i, label in enumerate(horizons)]
    return table.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def evaluate_horizons(
    features: DataFrame, keys: Sequence[str], ts: str, current: str, inputs: Sequence[str], horizons: Mapping[str, int],
    *, holdout_seconds: int = TWO_DAYS, settings: BoostedTrees = BoostedTrees(),
) -> DataFrame:
    """Train on all but the newest hold-out of each horizon (label -> seconds) and score model and persistence.

    Targets of all horizons and the assembled inputs of rows with a target are written once to the shared folder; the
    cuts are taken from there.  The horizons are fitted at the same time, each in a scheduler pool of its own, so one model's short jobs fill the cores that
    another one leaves idle; all predictions are scored in one pass.
    """
    spark = features.sparkSession
    ensure_checkpoint_dir(spark)
    targets = [f"target_{i}" for i in range(len(horizons))]
    ahead = _with_targets(features, keys, ts, current, horizons).where(
        " OR ".join(f"{t} IS NOT NULL" for t in targets))
    usable, columns = _usable(ahead, inputs)
    assembled = VectorAssembler(inputCols=columns, outputCol=_VECTOR).transform(usable).select(
        F.col(ts).alias("ts"), F.col(current).cast("double").alias("current"), *targets, _VECTOR)
    path = scratch_path(spark, "horizons")
    assembled.write.parquet(path)
    table = _with_splits(spark.read.schema(assembled.schema).parquet(path), "ts", horizons, holdout_seconds)

    def fit(i: int, label: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"forecast {label}")
        train = table.where(F.col(f"split_{i}") == "train").select(
            _VECTOR, (F.col(f"target_{i}") - F.col("current")).cast("double").alias("_delta"))
        return _trees(settings, "_delta", f"_delta_{i}").fit(_few_partitions(train, train.count()))

    with ThreadPoolExecutor(len(horizons)) as pool:
        models = list(pool.map(inheritable_thread_target(spark)(fit), range(len(horizons)), horizons))
    predicted = table
    for i, model in enumerate(models):
        predicted = model.transform(predicted).withColumn(
            f"prediction_{i}", clip_low(F.col("current") + F.col(f"_delta_{i}")))
    return _per_horizon(predicted, horizons, lambda i: score_columns(f"target_{i}", f"prediction_{i}", "current", f"split_{i}"))


def evaluate(
    features: DataFrame, keys: Sequence[str], ts: str, current: str, inputs: Sequence[str], horizon_seconds: int, **options,
) -> DataFrame:
    """:func:`evaluate_horizons` for one horizon."""
    return evaluate_horizons(features, keys, ts, current, inputs, {"": horizon_seconds}, **options).drop("horizon")


def importances(model: PipelineModel, inputs: Sequence[str], spark) -> DataFrame:
    """Weight of each feature (its missing-indicator included) in the fitted trees."""
    weights = model.stages[-1].featureImportances
    names = [n for f in inputs for n in (f, f)]
    pairs = [(name, float(weights[i])) for i, name in enumerate(names)]
    return (
        spark.createDataFrame(pairs, "feature STRING, importance DOUBLE")
        .groupBy("feature").agg(F.sum("importance").alias("importance"))
    )


__all__ = [
    "BoostedTrees", "evaluate", "evaluate_horizons", "fit_delta_trees", "horizon_baselines", "horizon_targets", "importances",
    "lag_features", "predict", "score_columns", "scores", "station_features", "station_rates", "station_series", "with_target",
]
