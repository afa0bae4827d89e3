"""The streaming jobs, drained over the events as a message topic."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pulsegrid.operators import stalls
from pulsegrid.plans.curate import CurateSpec
from pulsegrid.session import scratch_path
from pulsegrid.sources import envelope, parquet_stream, payload_columns, read_published
from pulsegrid.sources.messages import ENVELOPE
from pulsegrid.streaming import (
    BucketSpec, ExactSpec, ExtentSpec, JobFolders, ProgressLog, apply_batch, deduplicated, file_resume_audit, fold, merge_batch,
    progress_history, read_exact, read_states, start_append, start_curated, start_exact, start_raw,
)

from .registry import EVENTS_SQL, events, query, table
from .timeseries import bucket_sql

_TOPIC = "key STRING, value STRING, topic STRING, timestamp TIMESTAMP"
_PAYLOAD = "user_id BIGINT, k BIGINT, event_type STRING"


def _landed(spark, sf):
    """Events as broker records in a folder; every view is delivered twice."""
    rows = table(spark, sf, "events").withColumn("k", F.from_json("props", "k BIGINT")["k"])
    records = rows.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(F.struct("user_id", "k", "event_type")).alias("value"),
        F.lit("events").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
    )
    twice = records.unionByName(records.where(F.col("event_type") == "view")).drop("event_type")
    folder = scratch_path(spark, "landing")
    twice.repartition(spark.sparkContext.defaultParallelism).write.parquet(folder)
    return folder


def _drain(*queries):
    for q in queries:
        q.awaitTermination()


def _clean_folder(spark, sf):
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    topic = parquet_stream(spark, _landed(spark, sf), _TOPIC, files_per_trigger=2)
    _drain(start_raw(topic, JobFolders(raw, f"{raw}-checkpoint"), every=None, ingested_at=F.col("timestamp")))
    rows = payload_columns(
        parquet_stream(spark, raw, ENVELOPE), _PAYLOAD, {"user_id": "user_id", "k": "k", "event_type": "event_type"},
        ["key", "kafka_timestamp"])
    # files arrive in any order; the jobs' own default remembers every key
    unique = deduplicated(rows, ["key"], "kafka_timestamp")
    _drain(start_append(unique, JobFolders(clean, f"{clean}-checkpoint"), every=None))
    return clean


@query("stream_raw_to_clean", f"""
WITH {EVENTS_SQL} SELECT CAST(event_id AS VARCHAR) AS key, ts, user_id, k, event_type FROM ev
""")
def stream_raw_to_clean(spark, sf):
    rows = spark.read.parquet(_clean_folder(spark, sf))
    return rows.select("key", F.col("kafka_timestamp").cast("timestamp_ntz").alias("ts"), "user_id", "k", "event_type")


def _exact(spark, sf):
    """Messages as landed, every tenth cut short, through the exact job; the first batch's messages are applied again."""
    landed = spark.read.parquet(_landed(spark, sf))
    broken = F.when(F.col("key").cast("long") % 10 == 0, F.substring("value", 1, 5)).otherwise(F.col("value"))
    folder, root = scratch_path(spark, "broken"), scratch_path(spark, "exact")
    landed.withColumn("value", broken).repartition(12).write.parquet(folder)

    def parsed(rows):
        return rows.withColumn("m", F.from_json("value", _PAYLOAD)).select(
            "key", "value", F.col("timestamp").alias("kafka_timestamp"), "m.user_id", "m.k", "m.event_type")

    spec = ExactSpec(root, ["key"], "kafka_timestamp", F.col("user_id").isNotNull(), raw=["key", "value", "kafka_timestamp"], cuts=1, pages=1)
    _drain(start_exact(parsed(parquet_stream(spark, folder, _TOPIC, files_per_trigger=3)), spec, every=None))
    last = read_exact(spark, spec, "counts").agg(F.max("batch")).first()[0]
    again = read_exact(spark, spec, "bad")            # a batch of known bad ones and all clean rows: nothing is new
    rows = read_exact(spark, spec).unionByName(parsed(again.select("key", "value", F.col("kafka_timestamp").alias("timestamp"))))
    for _ in range(2):                                # applied twice, as after a failure
        apply_batch(rows, last + 1, spec)
    return spec


@query("stream_exact_clean", f"""
WITH {EVENTS_SQL} SELECT CAST(event_id AS VARCHAR) AS key, ts, user_id, k, event_type FROM ev WHERE event_id % 10 > 0
""")
def stream_exact_clean(spark, sf):
    rows = read_exact(spark, _exact(spark, sf))
    return rows.select("key", F.col("kafka_timestamp").cast("timestamp_ntz").alias("ts"), "user_id", "k", "event_type")


# views arrive twice; bad ones are kept as they came; the last batch brings everything once more
@query("stream_fanout_counts", """
WITH n AS (SELECT count(*) AS sent, count(*) FILTER (event_id % 10 > 0) AS good, count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (event_type = 'view' AND event_id % 10 > 0) AS good_views FROM events)
SELECT sent + views + good + (sent - good) + (views - good_views) AS n_read, good + good_views + good AS n_good,
       2 * (sent - good + views - good_views) AS n_bad, good AS n_clean, good_views + good AS n_repeated FROM n
""")
def stream_fanout_counts(spark, sf):
    counts = read_exact(spark, _exact(spark, sf), "counts")
    return counts.agg(*[F.sum(c).cast("long").alias(c) for c in ("n_read", "n_good", "n_bad", "n_clean", "n_repeated")])


_LIVE = CurateSpec(
    key="user_id", newest_by=["kafka_timestamp", "key"], part="k", whole="capacity",
    reference_fields=["capacity", "zone"], reference_newest_by=["capacity", "zone"],
    context_newest_by=["ts", "event_id"], context_fields={"context_value": "value"}, bounds=(1, 100),
    output=["user_id", "key", "k", "capacity", "zone", "rate", "context_value"],
)


@query("stream_curated", f"""
WITH {EVENTS_SQL},
newest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn FROM ev)
SELECT user_id, CAST(event_id AS VARCHAR) AS key, k, c_nationkey * 4 AS capacity, c_mktsegment AS zone,
       least(round(CAST(k AS DOUBLE) / (c_nationkey * 4) * 100, 1), 100.0::DOUBLE) AS rate,
       (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1) AS context_value
FROM newest JOIN customer ON c_custkey = user_id WHERE rn = 1 AND c_nationkey * 4 BETWEEN 1 AND 100
""")
def stream_curated(spark, sf):
    state, curated = scratch_path(spark, "state"), scratch_path(spark, "curated")
    clean = spark.readStream.schema("user_id BIGINT, k BIGINT, event_type STRING, key STRING, kafka_timestamp TIMESTAMP")
    stream = clean.option("maxFilesPerTrigger", 4).parquet(_clean_folder(spark, sf))

    def reference():
        return table(spark, sf, "customer").select(
            F.col("c_custkey").alias("user_id"), (F.col("c_nationkey") * 4).alias("capacity"),
            F.col("c_mktsegment").alias("zone"))

    _drain(start_curated(stream, reference, lambda: table(spark, sf, "events"), state, curated,
                         f"{curated}-checkpoint", spec=_LIVE, every=None))
    return read_published(spark, curated)


@query("envelope_by_topic", """
SELECT event_type AS topic, count(*) AS n_messages, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1
""")
def envelope_by_topic(spark, sf):
    records = table(spark, sf, "events").select(
        F.col("user_id").alias("key"), F.col("props").alias("value"), F.col("event_type").alias("topic"),
        F.col("ts").alias("timestamp"))
    return envelope(records).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_messages"), F.min("kafka_timestamp").alias("first_ts"),
        F.max("kafka_timestamp").alias("last_ts"))


_MINUTES = 120  # files of the topic, one a batch


# Events dealt to 120 files by id; 90 arrive before a restart and the rest after it.  Spark itself remembers the last 100
# commits of a process; the table has them all, and a time limit of no seconds finds each pause between two of them.
@query("stream_history", f"""
SELECT 'events' AS query, {_MINUTES}::BIGINT AS n_commits, 2::BIGINT AS n_runs, 0::BIGINT AS first_batch, {_MINUTES - 1}::BIGINT AS last_batch,
       count(*) AS input_rows, count(DISTINCT event_id % {_MINUTES}) - 1 AS n_pauses FROM events
""")
def stream_history(spark, sf):
    topic, log, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "history"), scratch_path(spark, "history-checkpoint")
    rows = table(spark, sf, "events").select("event_id", "user_id", F.pmod("event_id", F.lit(_MINUTES)).cast("int").alias("minute"))

    def run(part):
        part.repartition(_MINUTES, "minute").write.mode("append").partitionBy("minute").parquet(topic)
        stream = spark.readStream.schema("event_id BIGINT, user_id BIGINT").option("maxFilesPerTrigger", 1).parquet(topic)
        job = stream.drop("minute").writeStream.queryName("events").format("noop").option("checkpointLocation", checkpoint)
        job = job.trigger(availableNow=True).start()
        job.awaitTermination()
        history.wait(job)

    with ProgressLog(spark, log) as history:
        run(rows.where("minute < 90"))
        run(rows.where("minute >= 90"))
    commits = progress_history(spark, log)
    pauses = stalls(commits, ["query"], "committed_at", 0).agg(F.count("*")).scalar()
    return commits.groupBy("query").agg(
        F.count("*").alias("n_commits"), F.count_distinct("run_id").alias("n_runs"), F.min("batch_id").alias("first_batch"),
        F.max("batch_id").alias("last_batch"), F.sum("input_rows").alias("input_rows")).withColumn("n_pauses", pauses)


# Eight files: five batches commit, the sixth fails with two files planned, of which one is then lost; one more waits.
@query("stream_resume", """
SELECT p.part, CASE WHEN p.part < 5 THEN 'read' WHEN p.part = 5 THEN 'repeats' WHEN p.part = 6 THEN 'lost' ELSE 'waiting' END AS state,
       CASE WHEN p.part < 5 THEN p.part WHEN p.part < 7 THEN 5 END AS batch_id
FROM (SELECT DISTINCT event_id % 8 AS part FROM events) p
""")
def stream_resume(spark, sf):
    topic, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "resume-checkpoint")
    rows = table(spark, sf, "events").select("event_id", F.pmod("event_id", F.lit(8)).alias("part"))

    def land(part):
        rows.where(F.col("part") == part).coalesce(1).write.mode("append").partitionBy("part").parquet(topic)

    def run(files, work):
        stream = spark.readStream.schema("event_id BIGINT").option("maxFilesPerTrigger", files).parquet(topic)
        job = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            job.awaitTermination()
        except StreamingQueryException:
            pass                                     # the sixth batch

    def fail(batch, number):
        raise RuntimeError("the job ends here")

    for part in range(5):
        land(part)
        run(1, lambda batch, number: batch.write.format("noop").mode("append").save())
    land(5)
    land(6)
    run(2, fail)
    land(7)
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{topic}/part=6")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    found = file_resume_audit(spark, checkpoint, topic)
    return found.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint").alias("part"), "state", "batch_id")


def _merged(spark, sf, spec):
    """Six batches of events, one of them run twice and two folded, merged by the states alone."""
    root, rows = scratch_path(spark, "states"), events(spark, sf)
    for number in (0, 1, 2, 3, 2, 4):
        if number == 3:
            fold(spark, root, spec, 1)
        merge_batch(rows.where(F.pmod("event_id", F.lit(6)) == number), number, root, spec)
    merge_batch(rows.where("event_id % 6 = 0"), 0, root, spec)         # a replay of what the snapshot holds
    merge_batch(rows.where("event_id % 6 = 5"), 5, root, spec)
    return spec.finish(read_states(spark, root, spec))


@query("merged_buckets", f"WITH {bucket_sql('15 minutes')} SELECT * FROM series")
def merged_buckets(spark, sf):
    return _merged(spark, sf, BucketSpec(
        ["user_id"], "ts", "15 minutes", maxima=["k"], firsts=["event_type"], means=["value"], bucket="slot"))


@query("merged_extent", """
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_series, min(ts) AS first_ts, max(ts) AS last_ts FROM events
""")
def merged_extent(spark, sf):
    return _merged(spark, sf, ExtentSpec("user_id", "ts"))
