"""Daily profiles, standardisation, cluster summaries and demand."""

from pyspark.sql import functions as F

from pulsegrid.operators import (
    as_columns, cluster_dayparts, cluster_profiles, cluster_summary, hourly_demand, hourly_profile, interpolated, standardised,
    zone_imbalance,
)
from pulsegrid.plans.clusters import cluster_entities, profile_columns

from .registry import EVENTS_SQL, events, query, table

HOURS = range(24)
# Users of the test data cover 18 to 24 hours; 22 makes the threshold matter.
MIN_HOURS = 22
_WIDE = ", ".join(f"max(rate) FILTER (hour = {h}) AS h{h}" for h in HOURS)
PROFILE_SQL = f"""{EVENTS_SQL},
per_hour AS (SELECT user_id, hour(ts) AS hour, CAST(sum(value) AS DOUBLE) / count(value) AS rate FROM ev GROUP BY 1, 2),
kept AS (SELECT user_id FROM per_hour WHERE rate IS NOT NULL GROUP BY 1 HAVING count(*) >= {MIN_HOURS}),
wide AS (SELECT user_id, {_WIDE} FROM per_hour WHERE user_id IN (SELECT user_id FROM kept) GROUP BY 1)"""

# Interpolation stated over the long form, unlike the array expression it is compared with.
FILLED_SQL = f"""{PROFILE_SQL},
grid AS (SELECT user_id, CAST(h AS BIGINT) AS hour FROM kept, range(24) r(h)),
dense AS (SELECT g.user_id, g.hour, p.rate FROM grid g LEFT JOIN per_hour p ON p.user_id = g.user_id AND p.hour = g.hour),
marks AS (SELECT *,
    last_value(CASE WHEN rate IS NOT NULL THEN hour END IGNORE NULLS) OVER before AS h0,
    last_value(rate IGNORE NULLS) OVER before AS r0,
    first_value(CASE WHEN rate IS NOT NULL THEN hour END IGNORE NULLS) OVER after AS h1,
    first_value(rate IGNORE NULLS) OVER after AS r1
  FROM dense WINDOW before AS (PARTITION BY user_id ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    after AS (PARTITION BY user_id ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT user_id, hour, CASE WHEN h0 IS NULL THEN r1 WHEN h1 IS NULL OR h0 = h1 THEN r0
                                      ELSE r0 + (r1 - r0) * (hour - h0) / (h1 - h0) END AS rate FROM marks)"""


def profiles(spark, sf):
    return hourly_profile(events(spark, sf), "user_id", "ts", "value", MIN_HOURS)


def labels(spark, sf):
    """Given clusters: the label of the embedding with the user's number."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("user_id"), F.col("label").alias("cluster"))


_LABELS_SQL = "labels AS (SELECT vec_id AS user_id, label AS cluster FROM embeddings)"


@query("hourly_profile", f"WITH {PROFILE_SQL} SELECT * FROM wide")
def profile(spark, sf):
    return profiles(spark, sf)


_ROUNDED = ", ".join(f"round(max(rate) FILTER (hour = {h}), 7) AS h{h}" for h in HOURS)


@query("profile_interpolated", f"WITH {FILLED_SQL} SELECT user_id, {_ROUNDED} FROM filled GROUP BY 1")
def profile_interpolated(spark, sf):
    filled = as_columns(interpolated(profiles(spark, sf), "user_id"), "user_id")
    return filled.select("user_id", *[F.round(c, 7).alias(c) for c in profile_columns()])


_SCORED = ", ".join(f"round(max(z) FILTER (hour = {h}), 6) + 0.0::DOUBLE AS h{h}" for h in HOURS)


@query("profile_zscore", f"""
WITH {FILLED_SQL},
moments AS (SELECT hour, avg(rate) AS m, stddev_pop(rate) AS s FROM filled GROUP BY 1),
scored AS (SELECT user_id, hour, (rate - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS z FROM filled JOIN moments USING (hour))
SELECT user_id, {_SCORED} FROM scored GROUP BY 1
""")
def profile_zscore(spark, sf):
    scored = standardised(as_columns(interpolated(profiles(spark, sf), "user_id"), "user_id"), profile_columns())
    return scored.select("user_id", *[(F.round(c, 6) + 0.0).alias(c) for c in profile_columns()])


@query("hourly_demand", f"""
WITH {EVENTS_SQL}
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_readings, CAST(sum(value) AS DOUBLE) / count(value) AS mean_value
FROM ev GROUP BY 1
""")
def demand(spark, sf):
    return hourly_demand(events(spark, sf), "ts", "value")


@query("zone_imbalance", """
WITH c AS (SELECT c_mktsegment, CAST(c_acctbal AS DECIMAL(12,2)) AS bal FROM customer)
SELECT c_mktsegment, count(*) AS n_entities, CAST(sum(bal) AS DOUBLE) / count(bal) AS mean_rate,
       CAST(min(bal) AS DOUBLE) AS min_rate, CAST(max(bal) AS DOUBLE) AS max_rate,
       round(CAST(sum(bal) AS DOUBLE) / count(bal) - (SELECT CAST(sum(bal) AS DOUBLE) / count(bal) FROM c), 7) AS imbalance
FROM c GROUP BY 1
""")
def imbalance(spark, sf):
    balances = table(spark, sf, "customer").select("c_mktsegment", F.col("c_acctbal").cast("decimal(12,2)").alias("bal"))
    zones = zone_imbalance(balances, "c_mktsegment", "bal")
    return zones.withColumns({
        "min_rate": F.col("min_rate").cast("double"), "max_rate": F.col("max_rate").cast("double"),
        "imbalance": F.round("imbalance", 7)})


@query("cluster_summary", f"""
WITH {EVENTS_SQL}, {_LABELS_SQL}
SELECT cluster, count(DISTINCT user_id) AS n_entities, round(CAST(sum(value) AS DOUBLE) / count(value), 3) AS mean_rate,
       round(CAST(sum(k) AS DOUBLE) / count(k), 3) AS mean_capacity
FROM ev JOIN labels USING (user_id) GROUP BY 1
""")
def summary(spark, sf):
    return cluster_summary(events(spark, sf), labels(spark, sf), "user_id", "value", "k")


@query("cluster_profiles", f"""
WITH {FILLED_SQL}, {_LABELS_SQL}
SELECT cluster, CAST(hour AS INTEGER) AS hour, round(avg(rate), 10) AS rate, count(rate) AS n_entities
FROM filled JOIN labels USING (user_id) GROUP BY 1, 2
""")
def mean_profiles(spark, sf):
    out = cluster_profiles(interpolated(profiles(spark, sf), "user_id"), labels(spark, sf), "user_id")
    return out.withColumn("rate", F.round("rate", 10))


def _part_sql(a, b):
    chosen = f"FILTER (hour(ts) BETWEEN {a} AND {b})"
    return f"CAST(sum(value) {chosen} AS DOUBLE) / count(value) {chosen}"


@query("cluster_dayparts", f"""
WITH {EVENTS_SQL}, {_LABELS_SQL}
SELECT cluster, {_part_sql(0, 5)} AS night_rate, {_part_sql(7, 9)} AS morning_rate, {_part_sql(17, 19)} AS evening_rate
FROM ev JOIN labels USING (user_id) GROUP BY 1
""")
def dayparts(spark, sf):
    return cluster_dayparts(events(spark, sf), labels(spark, sf), "user_id", "ts", "value")


@query("kmeans_profiles")
def kmeans_profiles(spark, sf):
    base = profiles(spark, sf)
    found = cluster_entities(base, "user_id")
    return cluster_profiles(interpolated(base, "user_id"), found, "user_id").join(
        found.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size")), "cluster")

