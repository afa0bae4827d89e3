"""Exact median of a column of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.session import scratch_path

ACCURACY = 10_000      # of the approximate ranks that bracket the wanted ones
AT_ONCE = 50_000       # values between the brackets that one task may rank


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row, one DOUBLE column ``median`` (NULL for no values; NaN is no value).

    The built-in exact median keeps every distinct value in one task.  Here the values are stored once and
    narrowed by passes: two values that lie a little below and above the middle by approximate rank become
    brackets, and one aggregation counts exactly what lies below, at and between them.  About a 2,000th of the
    values lies between, so two or three passes do at any size; what is left, ``AT_ONCE`` values at most, is
    ranked.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "median")
    df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)").write.parquet(path)
    try:
        found = _middle(spark.read.schema("v DOUBLE").parquet(path))
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.range(1).select(F.lit(found).cast("double").alias("median"))


def _middle(values: DataFrame) -> float | None:
    total = values.count()
    if not total:
        return None
    first, second = (total + 1) // 2, total // 2 + 1                # the middle ranks, from 1
    below, count, inside = 0, total, values
    while count > AT_ONCE:
        slack = 2 / ACCURACY
        shares = [max((first - below) / count - slack, 0.0), min((second - below) / count + slack, 1.0)]
        low, high = inside.agg(F.percentile_approx("v", shares, ACCURACY)).first()[0]
        parts = _parts(inside, low, high)
        ends = {}
        for rank in (first, second):
            upto = below
            for part in parts:
                if upto < rank <= upto + part["n"]:
                    ends[rank] = (upto, part)
                    break
                upto += part["n"]
        (upto, part), (_, other) = ends[first], ends[second]
        if part is not other:                                       # neighbours in order, one on each side
            return _mean(part["high"], other["low"])
        if part["low"] == part["high"]:
            return part["low"]
        inside, below, count = inside.where(part["where"]), upto, part["n"]
    ranks = [(rank - below - 0.5) / count for rank in (first, second)]
    row = inside.agg(*[F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY v)") for share in ranks]).first()
    return _mean(*row)


def _parts(values: DataFrame, low: float, high: float) -> list[dict]:
    """Number and range of the values below, at, between, at and above two brackets, from one pass."""
    v = F.col("v")
    wheres = [v < low, v == low, (v > low) & (v < high), v == high, v > high]
    if low == high:
        wheres = [v < low, v == low, v > low]
    row = values.agg(*[measure for i, where in enumerate(wheres) for measure in (
        F.count_if(where).alias(f"n{i}"), F.min(F.when(where, v)).alias(f"low{i}"), F.max(F.when(where, v)).alias(f"high{i}"))]).first()
    return [{"n": row[f"n{i}"], "low": row[f"low{i}"], "high": row[f"high{i}"], "where": where} for i, where in enumerate(wheres)]


def _mean(low: float, high: float) -> float:
    return low if low == high else low / 2 + high / 2


def median_of(df: DataFrame, value: str) -> Column:
    """:func:`exact_median` as a scalar column."""
    return exact_median(df, value).scalar()


def fill_with_median(df: DataFrame, value: str, into: str | None = None) -> DataFrame:
    """Replace missing values by the median of the whole column."""
    return df.withColumn(into or value, F.coalesce(F.col(value).cast("double"), median_of(df, value)))
