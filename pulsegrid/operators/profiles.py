"""Hour-of-day profiles, standardisation and cluster summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions import fill_profile, mean_of

HOURS = tuple(range(24))


def hourly_profile(
    df: DataFrame, key: str, ts: str, rate: str, min_hours: int = 18, prefix: str = "h"
) -> DataFrame:
    """Entity x hour matrix of mean rates, for entities with enough covered hours.

    The first aggregation already reduces to 24 rows per entity before the pivot; explicit
    pivot values fix the columns and save the job that would look for them.
    """
    per_hour = df.groupBy(key, F.hour(ts).alias("hour")).agg(mean_of(rate).alias("rate"))
    wide = per_hour.groupBy(key).pivot("hour", list(HOURS)).agg(F.first("rate"))
    wide = wide.select(key, *[F.col(f"`{h}`").alias(f"{prefix}{h}") for h in HOURS])
    covered = sum((F.col(f"{prefix}{h}").isNotNull().cast("int") for h in HOURS), F.lit(0))
    return wide.where(covered >= min_hours)


def as_array(df: DataFrame, key: str, prefix: str = "h", name: str = "profile") -> DataFrame:
    return df.select(key, F.array(*[F.col(f"{prefix}{h}") for h in HOURS]).alias(name))


def as_columns(df: DataFrame, key: str, prefix: str = "h", name: str = "profile") -> DataFrame:
    return df.select(key, *[F.get(name, F.lit(h)).alias(f"{prefix}{h}") for h in HOURS])


def interpolated(df: DataFrame, key: str, prefix: str = "h") -> DataFrame:
    """Profiles as an array column ``profile``, with missing hours filled by a straight line and
    ends by the nearest hour."""
    return as_array(df, key, prefix).withColumn("profile", fill_profile(F.col("profile")))


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation per column; a constant column gets scale 1."""
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
        ).alias("moments")
    ).scalar()
    held = df.withColumn("_moments", moments)

    def score(c: str) -> Column:
        scale = F.col(f"_moments.s_{c}")
        return ((F.col(c) - F.col(f"_moments.m_{c}")) / F.when(scale == 0, 1.0).otherwise(scale)).alias(c)

    return held.select(*[c for c in df.columns if c not in columns], *[score(c) for c in columns])


def cluster_summary(df: DataFrame, labels: DataFrame, key: str, rate: str, capacity: str, digits: int = 3) -> DataFrame:
    """Entities, mean rate and mean capacity per cluster.

    Sums are taken per entity first, so the join with the labels moves one row per entity.
    """
    per_entity = df.groupBy(key).agg(
        F.sum(rate).alias("rate_sum"), F.count(rate).alias("rate_n"),
        F.sum(capacity).alias("cap_sum"), F.count(capacity).alias("cap_n"),
    )
    return (
        per_entity.join(labels, key)
        .groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("n_entities"),
            F.round(F.try_divide(F.sum("rate_sum").cast("double"), F.sum("rate_n")), digits).alias("mean_rate"),
            F.round(F.try_divide(F.sum("cap_sum").cast("double"), F.sum("cap_n")), digits).alias("mean_capacity"),
        )
    )


def cluster_profiles(profiles: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Mean profile of every cluster in long form: cluster, hour, rate, entities.

    ``profiles`` holds one ``profile`` array per entity.
    """
    return (
        profiles.select(key, "profile").join(labels, key)
        .select("cluster", F.posexplode("profile").alias("hour", "rate"))
        .groupBy("cluster", "hour")
        .agg(mean_of("rate").alias("rate"), F.count("rate").alias("n_entities"))
    )


# Hours of the published day parts.  "Night" is not defined by its source; 0-5 h is this package's choice.
DAY_PARTS = {"night": (0, 5), "morning": (7, 9), "evening": (17, 19)}


def cluster_dayparts(
    df: DataFrame, labels: DataFrame, key: str, ts: str, rate: str,
    parts: Mapping[str, tuple[int, int]] = DAY_PARTS,
) -> DataFrame:
    """Mean rate per cluster and part of the day (hour ranges are inclusive)."""
    hour = F.hour(ts)
    per_entity = df.groupBy(key).agg(
        *[F.sum(F.when(hour.between(a, b), F.col(rate))).alias(f"_{p}_s") for p, (a, b) in parts.items()],
        *[F.count(F.when(hour.between(a, b), F.col(rate))).alias(f"_{p}_n") for p, (a, b) in parts.items()],
    )
    return (
        per_entity.join(labels, key)
        .groupBy("cluster")
        .agg(*[
            F.try_divide(F.sum(f"_{p}_s").cast("double"), F.sum(f"_{p}_n")).alias(f"{p}_rate") for p in parts
        ])
    )


def hourly_demand(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Readings and mean value per hour of day."""
    return df.groupBy(F.hour(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_readings"), mean_of(value).alias("mean_value")
    )


def zone_imbalance(df: DataFrame, zone: str, rate: str) -> DataFrame:
    """Spread of occupancy inside and between zones, against the overall mean."""
    overall = df.agg(mean_of(rate).alias("m")).scalar()
    zones = df.groupBy(zone).agg(
        F.count(F.lit(1)).alias("n_entities"),
        mean_of(rate).alias("mean_rate"),
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
    )
    return zones.withColumn("imbalance", F.col("mean_rate") - overall)
