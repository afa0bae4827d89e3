"""Folders that grow, differ in their types or are sorted: compaction, promotion, look-ups by file ranges."""

from pyspark.sql import functions as F

from pulsegrid.functions import digest_sum, row_digest
from pulsegrid.operators import recovery_point
from pulsegrid.session import scratch_path
from pulsegrid.sources import backup_objects, compare_objects, restore_objects
from pulsegrid.sources import Compaction, live_files, read_live, read_promoted, read_range, write_sorted

from .audits import _TERM_SQL, _columns
from .registry import query, table

_SIDE_SQL = f"count(*) AS n_rows, CAST(sum({_TERM_SQL}) AS VARCHAR) AS checksum"


# Four fifths of the orders lie in 24 small files; the rest arrives in four more after the rewrite and before
# the swap.  A reader from before the swap still sees what it began with.
@query("compaction_live", f"""
WITH old AS (SELECT * FROM orders WHERE o_orderkey % 5 > 0)
SELECT 'before' AS phase, 24::BIGINT AS n_files, {_SIDE_SQL} FROM old
UNION ALL SELECT 'rewritten', 28, {_SIDE_SQL} FROM orders
UNION ALL SELECT 'swapped', 5, {_SIDE_SQL} FROM orders
UNION ALL SELECT 'old reader', 24, {_SIDE_SQL} FROM old
""")
def compaction_live(spark, sf):
    orders, folder = table(spark, sf, "orders"), scratch_path(spark, "growing")
    orders.where("o_orderkey % 5 > 0").repartition(24).write.parquet(folder)

    def state():
        return live_files(spark, folder).agg(F.count("*")).first()[0], read_live(spark, folder)

    states = {"before": state()}
    job = Compaction(spark, folder)
    job.rewrite()
    orders.where("o_orderkey % 5 = 0").repartition(4).write.mode("append").parquet(folder)
    states["rewritten"] = state()
    job.publish()
    states["swapped"] = state()
    states["old reader"] = states["before"]

    def side(phase, files, rows):
        return rows.agg(F.lit(phase).alias("phase"), F.lit(files).cast("long").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
                        digest_sum(row_digest(_columns())).alias("checksum"))

    first, *rest = [side(phase, *found) for phase, found in states.items()]
    for part in rest:
        first = first.unionByName(part)
    return first


# Customers in four folders: keys as INT and BIGINT, balances as FLOAT-free numbers of three kinds, one without
# the segment, one file that is no Parquet at all.
@query("schema_promotion", """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN 'n' || c_nationkey
         ELSE CAST(c_nationkey AS VARCHAR) END AS c_nation,
       CASE WHEN c_custkey % 4 IN (0, 1) THEN CAST(floor(c_acctbal) AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def schema_promotion(spark, sf):
    customer, root = table(spark, sf, "customer"), scratch_path(spark, "mixed-types")
    key, balance, nation = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    shapes = [
        {"c_custkey": key.cast("int"), "c_name": F.col("c_name"), "c_nation": nation.cast("int"),
         "c_acctbal": F.floor(balance).cast("int"), "c_mktsegment": F.col("c_mktsegment")},
        {"c_custkey": key.cast("bigint"), "c_name": F.col("c_name"), "c_nation": F.concat(F.lit("n"), nation),
         "c_acctbal": F.floor(balance).cast("bigint"), "c_mktsegment": F.col("c_mktsegment")},
        {"c_custkey": key.cast("int"), "c_name": F.col("c_name"), "c_nation": nation.cast("bigint"),
         "c_acctbal": balance, "c_mktsegment": F.col("c_mktsegment")},
        {"c_acctbal": balance, "c_custkey": key.cast("bigint"), "c_name": F.col("c_name"), "c_nation": nation.cast("string")},
    ]
    for i, columns in enumerate(shapes):
        customer.where(key % 4 == i).select(*[c.alias(n) for n, c in columns.items()]).write.parquet(f"{root}/part{i}")
    return read_promoted(spark, root)


@query("sorted_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity, true AS files_skipped
FROM lineitem WHERE l_partkey BETWEEN 40 AND 60 AND l_shipdate >= TIMESTAMP '1995-01-01'
""")
def sorted_lookup(spark, sf):
    root = scratch_path(spark, "sorted")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")
    write_sorted(lines, root, ["l_partkey", "l_shipdate"], 16)
    import datetime as dt

    found = read_range(spark, root, l_partkey=(40, 60), l_shipdate=(dt.datetime(1995, 1, 1), None))
    return found.rows.withColumn("files_skipped", F.lit(found.files_opened < found.files))


# Orders as text, a file per priority and status, three times: four fifths, then the rest after a first backup, then a status
# lost whole.  The second backup copies only what is new; lines have one byte a character and a line end.
_LINE_SQL = "length(CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR)) + 1"
_RECOVERED = ("phase string, objects_expected long, objects_intact long, objects_lost long, size_lost long, "
              "objects_copied long, bytes_copied long")


@query("object_recovery", f"""
WITH o AS (SELECT o_orderstatus AS s, o_orderpriority AS p, o_orderkey % 5 = 0 AS late, sum({_LINE_SQL}) AS bytes
           FROM orders GROUP BY 1, 2, 3),
n AS (SELECT count(*) AS objects, count(*) FILTER (s = 'P') AS lost, CAST(sum(bytes) FILTER (s = 'P') AS BIGINT) AS lost_bytes,
      count(*) FILTER (late) AS late, CAST(sum(bytes) FILTER (late) AS BIGINT) AS late_bytes FROM o)
SELECT 'lost' AS phase, objects AS objects_expected, objects - lost AS objects_intact, lost AS objects_lost, lost_bytes AS size_lost,
       late AS objects_copied, late_bytes AS bytes_copied FROM n
UNION ALL SELECT 'restored', objects, objects, 0, 0, lost, lost_bytes FROM n
""")
def object_recovery(spark, sf):
    root, store = scratch_path(spark, "objects"), scratch_path(spark, "object-store")
    lines = table(spark, sf, "orders").select(
        F.concat_ws(",", "o_orderkey", "o_custkey").alias("value"), "o_orderstatus", "o_orderpriority", "o_orderkey")

    def land(rows):
        rows.drop("o_orderkey").repartition("o_orderstatus", "o_orderpriority").write.mode("append").partitionBy(
            "o_orderstatus", "o_orderpriority").text(root)

    land(lines.where("o_orderkey % 5 > 0"))
    backup_objects(spark, root, store, "first")
    land(lines.where("o_orderkey % 5 = 0"))
    kept = backup_objects(spark, root, store, "second", after="first")
    lost = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/o_orderstatus=P")
    lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, True)

    def state(phase, copied):
        found = recovery_point(compare_objects(spark, root, store, "second")).first()
        done = copied.agg(F.count("*"), F.sum("bytes")).first()
        return (phase, *found, *done)

    after_loss = state("lost", kept.where("copied"))
    restored = restore_objects(spark, root, store, "second")
    return spark.createDataFrame([after_loss, state("restored", restored)], _RECOVERED)
