"""What a query will do when it is started again: its checkpoint's logs against what the source still holds.

Spark writes a batch's end positions to ``offsets`` before it runs and its number to ``commits`` when it is done.
A restart repeats the batches that have offsets but no commit and goes on from the newest position.  Positions are
read as tables here, so a lost range is known before the start, and not from the error or the gap it leaves.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.sources.files import inventory


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """batch_id and the lines, after the version, of the files of a log; batches folded into one file keep its number."""
    try:
        files = spark.read.text(folder, wholetext=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "value STRING").withColumn("name", F.lit(""))
    else:
        files = files.withColumn("name", F.col("_metadata.file_name"))
    number = F.regexp_extract("name", r"^(\d+)(\.compact)?$", 1)
    return files.where(number != "").select(number.try_cast("long").alias("batch_id"), F.slice(F.split("value", "\n"), 2, 1 << 30).alias("lines"))


def offset_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch_id, source (from 0), planned_at, position (the source's JSON; NULL before its first) and whether the batch committed.

    Spark keeps the last 100 batches or so (``spark.sql.streaming.minBatchesToRetain``); older ones have committed.
    """
    checkpoint = checkpoint.rstrip("/")
    commits = _log(spark, f"{checkpoint}/commits").select("batch_id", F.lit(True).alias("committed"))
    planned = F.timestamp_millis(F.get_json_object(F.col("lines")[0], "$.batchTimestampMs").cast("long"))
    positions = F.filter(F.slice("lines", 2, 1 << 30), lambda line: line != "")
    return (
        _log(spark, f"{checkpoint}/offsets")
        .select("batch_id", planned.alias("planned_at"), F.posexplode(positions).alias("source", "position"))
        .withColumn("position", F.when(F.col("position") != "-", F.col("position")))
        .join(commits, "batch_id", "left").withColumn("committed", F.coalesce("committed", F.lit(False)))
    )


def resume_point(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per source: the last committed batch and its position, and the batch that will be repeated first, if any."""
    log = offset_log(spark, checkpoint)
    return log.groupBy("source").agg(
        F.max(F.when(F.col("committed"), F.col("batch_id"))).alias("last_commit"),
        F.max_by("position", F.when(F.col("committed"), F.col("batch_id"))).alias("committed_position"),
        F.min(F.when(~F.col("committed"), F.col("batch_id"))).alias("repeats_batch"),
        F.max_by("position", "batch_id").alias("planned_position"),
    )


def topic_positions(points: DataFrame, position: str = "committed_position") -> DataFrame:
    """topic, partition and next offset of the broker positions among :func:`resume_point`'s rows."""
    offsets = F.from_json(position, "MAP<STRING, MAP<STRING, BIGINT>>")
    return (
        points.select("source", F.explode(offsets).alias("topic", "ends"))
        .select("source", "topic", F.explode("ends").alias("partition", "next_offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )


def topic_resume_audit(positions: DataFrame, available: DataFrame) -> DataFrame:
    """State of every partition on a restart, with the messages lost and waiting.

    ``available``: topic, partition, earliest and latest (one past the newest) offset that the broker holds.

    * ``resumes``: the next message is there, or will be the next to come.
    * ``lost range``: messages from the next to the earliest one are gone (retention passed the reader).
    * ``reset``: the broker's newest offset lies before the next one: the topic was made anew, so the checkpoint does
      not fit it.  How many messages were lost is not known from offsets.
    * ``gone``: the broker has no such partition.  ``new``: the checkpoint has none; it is read from its earliest message.
    """
    at, earliest, latest = F.col("next_offset"), F.col("earliest"), F.col("latest")
    state = (
        F.when(earliest.isNull(), "gone").when(at.isNull(), "new").when(at > latest, "reset").when(at < earliest, "lost range")
        .otherwise("resumes")
    )
    both = positions.select("topic", "partition", "next_offset").join(
        available.select("topic", "partition", "earliest", "latest"), ["topic", "partition"], "full")
    from_there = F.when(state.isin("new", "reset", "lost range"), earliest).when(state == "resumes", at)
    return both.select(
        "topic", "partition", state.alias("state"), "next_offset", "earliest", "latest",
        F.when(state == "lost range", earliest - at).when(state.isin("resumes", "new"), 0).cast("bigint").alias("lost_messages"),
        (latest - from_there).alias("waiting_messages"),
    )


def file_log(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """path and batch_id of every file that a file source has planned, the whole history."""
    lines = _log(spark, f"{checkpoint.rstrip('/')}/sources/{source}").select(F.explode("lines").alias("line")).where("line <> ''")
    entry = F.from_json("line", "path STRING, timestamp BIGINT, batchId BIGINT")
    # an entry may be in its own file and in one that several were folded into
    return lines.select(entry.alias("e")).groupBy(F.col("e.path").alias("path")).agg(F.min("e.batchId").alias("batch_id"))


def file_resume_audit(spark: SparkSession, checkpoint: str, root: str, source: int = 0) -> DataFrame:
    """State of every file of a file source on a restart: path, state, batch_id, bytes.

    ``read``: its batch committed and the file is still there; ``archived``: committed and gone.  ``repeats``: planned in a
    batch without a commit, which runs again; ``lost``: planned so, but gone.  ``waiting``: not planned yet.
    """
    log = offset_log(spark, checkpoint)
    open_from = log.where("NOT committed").agg(F.min("batch_id")).scalar()
    planned = log.agg(F.max("batch_id")).scalar()
    plain = F.url_decode(F.regexp_replace(F.regexp_replace("path", r"\+", "%2B"), "^([a-z0-9]+):/+", "$1:/"))
    seen = file_log(spark, checkpoint, source).select(plain.alias("path"), "batch_id")
    there = inventory(spark, {"": root}, gone_too=True).where(F.col("path").rlike(r"(?i)\.parquet$|\.json$|\.csv$|\.txt$"))
    there = there.select(F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("path"), "bytes")
    done = (F.col("batch_id") < open_from) | (open_from.isNull() & (F.col("batch_id") <= planned))
    state = (
        F.when(F.col("batch_id").isNull(), "waiting")
        .when(F.coalesce(done, F.lit(False)), F.when(F.col("bytes").isNull(), "archived").otherwise("read"))
        .otherwise(F.when(F.col("bytes").isNull(), "lost").otherwise("repeats"))
    )
    return there.join(seen, "path", "full").select("path", state.alias("state"), "batch_id", "bytes")
