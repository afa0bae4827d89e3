"""Buckets, look-ups, splits, gaps, calendar features and fills."""

from pyspark.sql import functions as F

from pulsegrid.functions import calendar_parts, share_of
from pulsegrid.operators import (
    bucket_series, exact_median, fill_with_median, first_per_key, gap_report, offset_lookup, series_extent,
    temporal_split,
)
from pulsegrid.plans.forecast import lag_features, with_target
from pulsegrid.sources import split_retention

from .registry import EVENTS_SQL, events, query, table

DAY = 86_400


def bucketed(spark, sf, width):
    """Readings per user on a regular grid, after removing repeats of (user, time)."""
    unique = first_per_key(events(spark, sf), ["user_id", "ts"], ["event_id"])
    return bucket_series(unique, ["user_id"], "ts", width, maxima=["k"], firsts=["event_type"], means=["value"],
                         bucket="slot")


def bucket_sql(width):
    return f"""{EVENTS_SQL},
series AS (
  SELECT user_id, time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01') AS slot, max(k) AS k,
         arg_min(event_type, ts) AS event_type,
         CAST(round_even(CAST(sum(value) AS DOUBLE) / count(value), 0) AS BIGINT) AS value
  FROM ev GROUP BY 1, 2)"""


DAILY_SQL = bucket_sql("1 day")


@query("bucket_15min", f"WITH {bucket_sql('15 minutes')} SELECT * FROM series")
def bucket_15min(spark, sf):
    return bucketed(spark, sf, "15 minutes")


@query("bucket_1day", f"WITH {DAILY_SQL} SELECT * FROM series")
def bucket_1day(spark, sf):
    return bucketed(spark, sf, "1 day")


@query("series_extent", """
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_series, min(ts) AS first_ts, max(ts) AS last_ts FROM events
""")
def extent(spark, sf):
    return series_extent(table(spark, sf, "events"), ["user_id"], "ts")


def _gap_sql(width, step, target):
    return f"""WITH {bucket_sql(width)},
g AS (SELECT user_id, slot, lag(slot) OVER (PARTITION BY user_id ORDER BY slot) AS before FROM series),
a AS (SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_series, count(before) AS n_steps,
             count(*) FILTER (before = slot - INTERVAL '{step}') AS n_exact_steps,
             count(DISTINCT CAST(slot AS DATE)) AS present,
             date_diff('day', CAST(min(slot) AS DATE), CAST(max(slot) AS DATE)) + 1 AS days_spanned FROM g),
t AS (SELECT count(*) AS n_with_target FROM series x JOIN series y
      ON x.user_id = y.user_id AND y.slot = x.slot + INTERVAL '{target}')
SELECT n_rows, n_series, n_steps, n_exact_steps, CAST(n_exact_steps AS DOUBLE) / nullif(n_steps, 0) AS exact_step_share,
       n_with_target, days_spanned, days_spanned - present AS days_missing FROM a, t"""


@query("gap_report", _gap_sql("15 minutes", "15 minutes", "1 hour"))
def gaps(spark, sf):
    return gap_report(bucketed(spark, sf, "15 minutes"), ["user_id"], "slot", 900, 3600)


@query("gap_report_daily", _gap_sql("1 day", "1 day", "1 day"))
def gaps_daily(spark, sf):
    return gap_report(bucketed(spark, sf, "1 day"), ["user_id"], "slot", DAY, DAY)


LAGS = {"lag_1": DAY, "lag_2": 2 * DAY, "lag_3": 3 * DAY, "lag_4": 4 * DAY}
_LAG_JOINS = " ".join(
    f"LEFT JOIN series l{i} ON l{i}.user_id = s.user_id AND l{i}.slot = s.slot - INTERVAL '{i} days'"
    for i in range(1, 5))
_LAG_SUM = " + ".join(f"coalesce(l{i}.value, 0)" for i in range(1, 5))
_LAG_N = " + ".join(f"CAST(l{i}.value IS NOT NULL AS INTEGER)" for i in range(1, 5))
LAG_SQL = f"""{DAILY_SQL},
lagged AS (
  SELECT s.user_id, s.slot, s.value, l1.value AS lag_1, l2.value AS lag_2, l3.value AS lag_3, l4.value AS lag_4,
         CAST({_LAG_SUM} AS DOUBLE) / nullif({_LAG_N}, 0) AS roll_mean_lag
  FROM series s {_LAG_JOINS})"""


def lagged(spark, sf):
    daily = bucketed(spark, sf, "1 day").select("user_id", "slot", "value")
    return lag_features(daily, ["user_id"], "slot", "value", LAGS)


@query("lag_features", f"WITH {LAG_SQL} SELECT * FROM lagged")
def lags(spark, sf):
    return lagged(spark, sf)


@query("offset_lookup_15min", f"""
WITH {bucket_sql('15 minutes')}
SELECT s.user_id, s.slot, s.value, b.value AS lag_15, a.value AS ahead_60 FROM series s
LEFT JOIN series b ON b.user_id = s.user_id AND b.slot = s.slot - INTERVAL '15 minutes'
LEFT JOIN series a ON a.user_id = s.user_id AND a.slot = s.slot + INTERVAL '60 minutes'
""")
def offset_15min(spark, sf):
    grid = bucketed(spark, sf, "15 minutes").select("user_id", "slot", "value")
    return offset_lookup(grid, ["user_id"], "slot", "value", {"lag_15": -900, "ahead_60": 3600})


TARGET_SQL = f"""{DAILY_SQL},
targeted AS (SELECT s.user_id, s.slot, s.value, t.value AS target FROM series s
  JOIN series t ON t.user_id = s.user_id AND t.slot = s.slot + INTERVAL '1 day'),
cut AS (SELECT max(slot) - INTERVAL '2 days' AS c FROM targeted)"""


def targeted(spark, sf):
    daily = bucketed(spark, sf, "1 day").select("user_id", "slot", "value")
    return with_target(daily, ["user_id"], "slot", "value", DAY)


@query("horizon_target", f"WITH {TARGET_SQL} SELECT * FROM targeted")
def horizon_target(spark, sf):
    return targeted(spark, sf)


@query("temporal_split", f"""
WITH {TARGET_SQL}
SELECT user_id, slot, value, target, CASE WHEN slot <= c THEN 'train' ELSE 'test' END AS split FROM targeted, cut
""")
def split(spark, sf):
    return temporal_split(targeted(spark, sf), "slot", 2 * DAY)


@query("calendar_features", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dow,
       CAST(isodow(ts) >= 6 AS INTEGER) AS weekend,
       round(sin(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440), 9) + 0.0::DOUBLE AS sin_t,
       round(cos(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440), 9) + 0.0::DOUBLE AS cos_t,
       CAST(event_type = 'view' AS INTEGER) AS is_view
FROM events
""")
def calendar_features(spark, sf):
    parts = calendar_parts("ts")
    parts["sin_t"] = F.round(parts["sin_t"], 9) + 0.0
    parts["cos_t"] = F.round(parts["cos_t"], 9) + 0.0
    parts["is_view"] = F.col("event_type").eqNullSafe(F.lit("view")).cast("int")
    return table(spark, sf, "events").select("event_id", *[c.alias(name) for name, c in parts.items()])


@query("occupancy_ratio", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
       CASE WHEN p_size > 10 THEN l_quantity / (p_size - 10) END AS ratio
FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def occupancy_ratio(spark, sf):
    docks = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") - 10).alias("docks"))
    return table(spark, sf, "lineitem").join(docks, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
        share_of("l_quantity", "docks").alias("ratio"))


# A size of 50 stands for "not reported".
@query("median_fill", """
WITH s AS (SELECT p_partkey, nullif(p_size, 50) AS size FROM part)
SELECT p_partkey, CAST(coalesce(size, (SELECT median(size) FROM s)) AS DOUBLE) AS size FROM s
""")
def median_fill(spark, sf):
    sizes = table(spark, sf, "part").select("p_partkey", F.nullif("p_size", F.lit(50)).alias("size"))
    return fill_with_median(sizes, "size")


@query("exact_median", "SELECT median(l_extendedprice) AS median FROM lineitem")
def median(spark, sf):
    return exact_median(table(spark, sf, "lineitem"), "l_extendedprice")


_RETENTION_SQL = "SELECT * FROM orders WHERE (o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY)"


def _retention(spark, sf):
    orders = table(spark, sf, "orders")
    return split_retention(orders, "o_orderdate", orders.agg(F.max("o_orderdate")).scalar(), 30)


@query("retention_expired", f"{_RETENTION_SQL} = true")
def retention_expired(spark, sf):
    return _retention(spark, sf).where("expired").drop("expired")


@query("retention_kept", f"{_RETENTION_SQL} = false")
def retention_kept(spark, sf):
    return _retention(spark, sf).where("NOT expired").drop("expired")
