"""Quality gate, model constraints and orphans."""

from pyspark.sql import functions as F

from pulsegrid.operators import (
    accepted, constraint_violations, expectation_results, gate_report, orphan_keys, quarantined, reason_counts,
    with_errors,
)
from pulsegrid.plans.stations import GATE_EXPECTATIONS, GATE_RULES

from .registry import query, table

# Customers seen as station rows with every kind of defect: blank codes, negative rates,
# missing and too large capacities, unreadable bike counts, too warm readings.
_INPUT_SQL = """src AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS stationcode,
         c_acctbal / 100 AS taux_occupation, nullif(c_nationkey * 10, 0) AS capacity,
         CASE WHEN c_nationkey = 3 THEN 'n/a' ELSE CAST(CAST(floor(abs(c_acctbal) / 40) AS BIGINT) AS VARCHAR) END AS numbikesavailable,
         c_nationkey * 3.0::DOUBLE - 20 AS meteo_temp
  FROM customer)"""
_CHECKED_SQL = f"""{_INPUT_SQL},
num AS (SELECT *, TRY_CAST(numbikesavailable AS DOUBLE) AS bikes FROM src),
broken AS (
  SELECT *,
    CASE WHEN stationcode IS NULL OR trim(stationcode) = '' THEN 'stationcode_null_or_empty' END AS e0,
    CASE WHEN taux_occupation IS NULL OR taux_occupation NOT BETWEEN 0 AND 100 THEN 'taux_occupation_out_of_range' END AS e1,
    CASE WHEN capacity IS NULL OR capacity NOT BETWEEN 0 AND 200 THEN 'capacity_out_of_range' END AS e2,
    CASE WHEN bikes IS NULL OR bikes NOT BETWEEN 0 AND 200 THEN 'numbikesavailable_out_of_range' END AS e3,
    CASE WHEN meteo_temp IS NULL OR meteo_temp NOT BETWEEN -30 AND 50 THEN 'meteo_temp_out_of_range' END AS e4,
    CASE WHEN bikes > capacity THEN 'numbikesavailable_greater_than_capacity' END AS e5
  FROM num),
checked AS (
  SELECT *, concat_ws('|', e0, e1, e2, e3, e4, e5) AS errors,
    {" + ".join(f"CAST(e{i} IS NOT NULL AS INTEGER)" for i in range(6))} AS n_errors FROM broken)"""
_COLUMNS = "c_custkey, stationcode, taux_occupation, capacity, numbikesavailable, meteo_temp"


def gate_input(spark, sf):
    nation = F.col("c_nationkey")
    segment = F.col("c_mktsegment")
    bikes = F.floor(F.abs("c_acctbal") / 40).cast("bigint").cast("string")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", "  ").when(segment == "MACHINERY", F.lit(None)).otherwise(F.col("c_name"))
        .alias("stationcode"),
        (F.col("c_acctbal") / 100).alias("taux_occupation"),
        F.nullif(nation * 10, F.lit(0)).alias("capacity"),
        F.when(nation == 3, "n/a").otherwise(bikes).alias("numbikesavailable"),
        (nation * F.lit(3.0) - 20).alias("meteo_temp"),
    )


@query("quality_errors", f"""
WITH {_CHECKED_SQL} SELECT c_custkey, errors, n_errors FROM checked
""")
def quality_errors(spark, sf):
    checked = with_errors(gate_input(spark, sf), GATE_RULES)
    return checked.select("c_custkey", F.concat_ws("|", "_errors").alias("errors"), F.size("_errors").alias("n_errors"))


@query("quality_accepted", f"WITH {_CHECKED_SQL} SELECT {_COLUMNS} FROM checked WHERE n_errors = 0")
def quality_accepted(spark, sf):
    return accepted(with_errors(gate_input(spark, sf), GATE_RULES))


@query("quality_quarantine", f"""
WITH {_CHECKED_SQL} SELECT {_COLUMNS}, errors AS _quality_errors FROM checked WHERE n_errors > 0
""")
def quality_quarantine(spark, sf):
    return quarantined(with_errors(gate_input(spark, sf), GATE_RULES))


@query("quality_reason_counts", f"""
WITH {_CHECKED_SQL} SELECT reason, count(*) AS n_rows FROM ({" UNION ALL ".join(f"SELECT e{i} AS reason FROM checked" for i in range(6))})
WHERE reason IS NOT NULL GROUP BY 1
""")
def quality_reason_counts(spark, sf):
    return reason_counts(gate_input(spark, sf), GATE_RULES)


def _between_sql(position, column, low, high):
    value = "bikes" if column == "numbikesavailable" else column
    return (f"SELECT {position} AS position, 'between' AS expectation, '{column}' AS column_name, "
            f"count(*) FILTER ({value} NOT BETWEEN {low} AND {high}) AS unexpected FROM num")


_EXPECT_SQL = f"""WITH {_CHECKED_SQL}, results AS (
SELECT 0 AS position, 'row_count_between' AS expectation, 'table' AS column_name,
       CAST(CASE WHEN count(*) BETWEEN 1 AND 100000 THEN 0 ELSE 1 END AS BIGINT) AS unexpected FROM num
UNION ALL SELECT 1, 'not_null', 'stationcode', count(*) FILTER (stationcode IS NULL) FROM num
UNION ALL {_between_sql(2, 'taux_occupation', 0, 100)}
UNION ALL {_between_sql(3, 'capacity', 0, 200)}
UNION ALL {_between_sql(4, 'numbikesavailable', 0, 200)}
UNION ALL {_between_sql(5, 'meteo_temp', -30, 50)})"""


@query("expectations", f"{_EXPECT_SQL} SELECT *, unexpected = 0 AS success FROM results")
def expectations(spark, sf):
    return expectation_results(gate_input(spark, sf), GATE_EXPECTATIONS)


@query("quality_report", f"""{_EXPECT_SQL}
SELECT 'run-1' AS run_id, CASE WHEN bad = 0 THEN 'PASS' ELSE 'PASS_WITH_QUARANTINE' END AS status, false AS strict_mode,
       n AS input_rows, n - bad AS accepted_rows, bad AS quarantined_rows,
       CAST((SELECT count(*) FROM results WHERE unexpected = 0) AS INTEGER) AS expectations_passed, 6 AS expectations_total
FROM (SELECT count(*) AS n, count(*) FILTER (n_errors > 0) AS bad FROM checked)
""")
def quality_report(spark, sf):
    return gate_report(gate_input(spark, sf), GATE_RULES, GATE_EXPECTATIONS, run_id="run-1")


@query("model_constraints", """
SELECT 'unique_key' AS constraint_name, (SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem) AS violations
UNION ALL SELECT 'key_not_null', (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL)
UNION ALL SELECT 'quantity_not_negative', (SELECT count(*) FROM lineitem WHERE NOT l_quantity >= 0)
UNION ALL SELECT 'discount_at_most_5_percent', (SELECT count(*) FROM lineitem WHERE NOT l_discount <= 0.05)
UNION ALL SELECT 'not_returned', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R')
""")
def model_constraints(spark, sf):
    return constraint_violations(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
        {
            "quantity_not_negative": F.col("l_quantity") >= 0,
            "discount_at_most_5_percent": F.col("l_discount") <= 0.05,
            "not_returned": F.col("l_returnflag") != "R",
        },
    )


@query("fk_orphans", """
SELECT l_partkey, count(*) AS n_rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 40) GROUP BY 1
""")
def fk_orphans(spark, sf):
    return orphan_keys(table(spark, sf, "lineitem"), "l_partkey", keep(table(spark, sf, "part")), "p_partkey")


def keep(parts):
    """The tables have no orphans; parts above size 40 count as unknown."""
    return parts.where(F.col("p_size") <= 40)


_COUNTS = "count(*) AS n_rows"


@query("star_projection", f"""
SELECT c_mktsegment, p_brand, {_COUNTS}, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
GROUP BY 1, 2
""")
def star_projection(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").cast("decimal(12,2)").alias("q"))
    owners = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (
        lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("c_mktsegment", "p_brand")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("q").cast("double").alias("quantity"))
    )
