"""Newest state, rates, bounds and de-duplication."""

from pyspark.sql import functions as F

from pulsegrid.functions import band, cap_at, percent_of
from pulsegrid.operators import first_per_key, keep_in_range, latest_per_key, newest_row
from pulsegrid.plans.curate import CurateSpec, curate

from .registry import query, table

# Every column takes part in the order, so ties on the ship date are settled.
NEWEST = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
          "l_tax", "l_returnflag", "l_linestatus"]
_NEWEST_SQL = ", ".join(f"{c} DESC" for c in NEWEST)

_LATEST_SQL = f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {_NEWEST_SQL}) AS rn FROM lineitem)
  WHERE rn = 1)"""

SNAPSHOT = CurateSpec(
    key="l_partkey",
    newest_by=NEWEST,
    part="l_quantity",
    whole="p_size",
    reference_fields=["p_name", "p_brand", "p_size"],
    reference_newest_by=["p_name", "p_brand", "p_size"],
    context_newest_by=["ts", "event_id"],
    context_fields={"context_value": "value", "context_type": "event_type"},
    bounds=(1, 45),
    output=["l_partkey", "p_name", "p_brand", "p_size", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity",
            "rate", "context_value", "context_type"],
)


@query("latest_per_key", f"""
WITH {_LATEST_SQL}
SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM latest
""")
def latest(spark, sf):
    rows = latest_per_key(table(spark, sf, "lineitem"), ["l_partkey"], NEWEST)
    return rows.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                       "l_extendedprice")


@query("latest_state_enriched", f"""
WITH {_LATEST_SQL},
w AS (SELECT value AS context_value, event_type AS context_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)
SELECT l_partkey, p_name, p_brand, p_size, l_orderkey, l_linenumber, l_shipdate, l_quantity,
       least(round(l_quantity / p_size * 100, 1), 100.0::DOUBLE) AS rate, context_value, context_type
FROM latest LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN w ON true
WHERE p_size BETWEEN 1 AND 45
""")
def latest_state_enriched(spark, sf):
    reference = table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    return curate(table(spark, sf, "lineitem"), reference, table(spark, sf, "events"), SNAPSHOT)


# Usable docks: size minus ten, which is zero for some parts (no rate) and negative for others.
_RATED_SQL = """rated AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
         round(l_quantity / nullif(p_size - 10, 0) * 100, 1) AS rate
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""
_RATED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "rate"]


def _rated(spark, sf):
    sizes = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") - 10).alias("docks"))
    return (
        table(spark, sf, "lineitem").join(sizes, "l_partkey")
        .withColumn("rate", percent_of("l_quantity", "docks")).select(*_RATED)
    )


@query("occupancy_rate", f"WITH {_RATED_SQL} SELECT * FROM rated")
def occupancy_rate(spark, sf):
    return _rated(spark, sf)


@query("capped_rate", f"""
WITH {_RATED_SQL}
SELECT * REPLACE (CASE WHEN rate IS NOT NULL THEN least(rate, 100.0::DOUBLE) END AS rate) FROM rated
""")
def capped_rate(spark, sf):
    return _rated(spark, sf).withColumn("rate", cap_at("rate"))


@query("capped_rate_missing_full", f"""
WITH {_RATED_SQL} SELECT * REPLACE (least(coalesce(rate, 100.0::DOUBLE), 100.0::DOUBLE) AS rate) FROM rated
""")
def capped_rate_missing_full(spark, sf):
    return _rated(spark, sf).withColumn("rate", cap_at("rate", missing_is_limit=True))


@query("valid_range_filter", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 1 AND p_size <= 40")
def valid_range_filter(spark, sf):
    return keep_in_range(table(spark, sf, "part"), "p_size", 1, 40).select("p_partkey", "p_name", "p_size")


@query("top1_latest", """
SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1
""")
def top1_latest(spark, sf):
    return newest_row(table(spark, sf, "events").drop("props"), ["ts", "event_id"])


@query("dedup_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
             l_linestatus) AS rn FROM lineitem)
WHERE rn = 1
""")
def dedup_keep_first(spark, sf):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    rows = first_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                       "l_extendedprice")


@query("tension_bands", f"""
WITH {_RATED_SQL}
SELECT p_brand, CASE WHEN rate IS NULL THEN 'unknown' WHEN rate <= 5 THEN 'near_empty'
                     WHEN rate >= 95 THEN 'near_full' ELSE 'balanced' END AS tension, count(*) AS n_readings
FROM rated JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
""")
def tension_bands(spark, sf):
    entities = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand",
                                               (F.col("p_size") - 10).alias("docks"))
    readings = table(spark, sf, "lineitem").select("l_partkey", "l_quantity").join(entities, "l_partkey")
    tension = band(percent_of("l_quantity", "docks")).alias("tension")
    return readings.groupBy("p_brand", tension).agg(F.count(F.lit(1)).alias("n_readings"))
