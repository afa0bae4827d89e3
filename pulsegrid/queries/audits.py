"""Checksums, write integrity, delivery and recovery audits."""

from pyspark.sql import functions as F

from pulsegrid.operators import (
    content_manifest, delivery_audit, manifest_diff, recovery_point, table_checksum, write_integrity,
)
from pulsegrid.session import scratch_path

from .registry import query, table

_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _columns():
    return [*_FIELDS, F.col("o_totalprice").cast("decimal(12,2)")]


_TEXT_SQL = ", ".join([f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in _FIELDS]
                      + ["coalesce(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '\\N')"])
_TERM_SQL = f"CAST('0x' || substr(sha256(concat_ws(chr(31), {_TEXT_SQL})), 1, 15) AS BIGINT)"


@query("table_checksum", f"SELECT count(*) AS n_rows, CAST(sum({_TERM_SQL}) AS VARCHAR) AS checksum FROM orders")
def checksum(spark, sf):
    return table_checksum(table(spark, sf, "orders"), _columns())


@query("write_integrity", "SELECT count(*) AS rows_written, count(*) AS rows_reread, true AS intact FROM orders")
def integrity(spark, sf):
    orders = table(spark, sf, "orders")
    target = scratch_path(spark, "integrity")
    orders.write.parquet(target)
    return write_integrity(orders, spark.read.parquet(target), _columns())


# Objects are (status, priority) groups of orders.  In the copy one group is gone and the
# prices of another were cut to whole units.
_OBJECT_SQL = "o_orderstatus || '/' || o_orderpriority"
_COPY_SQL = """(SELECT * REPLACE (CASE WHEN o_orderpriority = '2-HIGH' THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW'))"""


def _manifest_sql(source):
    return f"""SELECT {_OBJECT_SQL} AS path, count(*) AS n_rows, CAST(sum({_TERM_SQL}) AS VARCHAR) AS checksum
  FROM {source} GROUP BY 1"""


_DIFF_SQL = f"""a AS ({_manifest_sql('orders')}), b AS ({_manifest_sql(_COPY_SQL)}),
diff AS (SELECT coalesce(a.path, b.path) AS path, a.n_rows AS original_size, b.n_rows AS copy_size,
  CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'unexpected'
       WHEN a.checksum = b.checksum THEN 'same' ELSE 'changed' END AS state
  FROM a FULL JOIN b ON a.path = b.path)"""


def _diff(spark, sf):
    orders = table(spark, sf, "orders")
    gone = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    cut = F.when(F.col("o_orderpriority") == "2-HIGH", F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice"))
    copy = orders.where(~gone).withColumn("o_totalprice", cut)
    path = F.concat_ws("/", "o_orderstatus", "o_orderpriority")
    return manifest_diff(content_manifest(orders, path, _columns()), content_manifest(copy, path, _columns()))


@query("manifest_diff", f"WITH {_DIFF_SQL} SELECT * FROM diff")
def diff(spark, sf):
    return _diff(spark, sf)


@query("recovery_point", f"""
WITH {_DIFF_SQL}
SELECT count(*) FILTER (state <> 'unexpected') AS objects_expected, count(*) FILTER (state = 'same') AS objects_intact,
       count(*) FILTER (state IN ('missing', 'changed')) AS objects_lost,
       CAST(coalesce(sum(original_size) FILTER (state IN ('missing', 'changed')), 0) AS BIGINT) AS size_lost FROM diff
""")
def recovery(spark, sf):
    return recovery_point(_diff(spark, sf))


# Sent: one message per order.  Received: one per order line's order (duplicates, some never), plus part names.
@query("delivery_audit", """
WITH e AS (SELECT CAST(o_orderkey AS VARCHAR) AS m FROM orders),
c AS (SELECT CAST(l_orderkey AS VARCHAR) AS m FROM lineitem UNION ALL SELECT p_name FROM part),
f AS (SELECT m, CAST(sum(e) AS BIGINT) AS e, CAST(sum(c) AS BIGINT) AS c FROM (
        SELECT m, 1 AS e, 0 AS c FROM e UNION ALL SELECT m, 0, 1 FROM c) GROUP BY 1),
t AS (SELECT *, CAST(CAST('0x' || substr(sha256(m), 1, 15) AS BIGINT) AS HUGEINT) AS h FROM f)
SELECT CAST(sum(e) AS BIGINT) AS expected_count, CAST(sum(c) AS BIGINT) AS consumed_count,
       count(*) FILTER (c > 0) AS unique_consumed_count, CAST(sum(greatest(e - c, 0)) AS BIGINT) AS missing_count,
       count(*) FILTER (e = 0 AND c > 0) AS unexpected_count, CAST(sum(greatest(c - 1, 0)) AS BIGINT) AS duplicated_count,
       CAST(sum(h * e) AS VARCHAR) AS expected_checksum, CAST(sum(h * c) AS VARCHAR) AS consumed_checksum,
       sum(h * e) = sum(h * c) AS intact FROM t
""")
def delivery(spark, sf):
    sent = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("m"))
    received = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("m")).union(
        table(spark, sf, "part").select("p_name"))
    return delivery_audit(sent, received, "m")
