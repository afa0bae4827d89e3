"""The progress table and the audit of a restart."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pulsegrid.sources import retain_days
from pulsegrid.streaming import (
    ProgressLog, file_resume_audit, offset_log, progress_history, resume_point, topic_positions, topic_resume_audit,
)


def land(spark, root, *values):
    for value in values:
        spark.createDataFrame([(value,)], "v INT").coalesce(1).write.mode("append").parquet(f"{root}/topic")


def start(spark, root, work=lambda batch, number: batch.count(), name="job"):
    stream = spark.readStream.schema("v INT").option("maxFilesPerTrigger", 1).parquet(f"{root}/topic")
    writer = stream.writeStream.queryName(name).foreachBatch(work).option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(availableNow=True).start()


def test_history_outlives_runs_and_holds_whole_files(spark, tmp_path):
    root, log = str(tmp_path), str(tmp_path / "log")
    assert progress_history(spark, log).count() == 0
    for values in (range(5), range(5, 8)):
        land(spark, root, *values)
        with ProgressLog(spark, log, every=4) as history:
            job = start(spark, root)
            job.awaitTermination()
            assert history.wait(job)
    rows = progress_history(spark, log).orderBy("batch_id").collect()
    assert [r["batch_id"] for r in rows] == list(range(8)) and {r["input_rows"] for r in rows} == {1}
    assert len({r["run_id"] for r in rows}) == 2 and {r["query"] for r in rows} == {"job"}
    assert all(a["committed_at"] <= b["committed_at"] for a, b in zip(rows, rows[1:]))
    files = [f for _, _, names in os.walk(log) for f in names if f.endswith(".json")]
    assert 3 <= len(files) <= 5                                     # 4 + 1, 3; more if the day changes meanwhile
    today = max(r["day"] for r in rows)
    assert progress_history(spark, log, since=today + dt.timedelta(days=1)).count() == 0
    retain_days(spark, log, (today + dt.timedelta(days=40)).isoformat(), 30, column="day")
    assert not [f for _, _, names in os.walk(log) for f in names if f.endswith(".json")]


def test_restart_repeats_what_did_not_commit(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, 0, 1, 2)

    def fail(batch, number):
        if number == 2:
            raise RuntimeError("the job ends here")

    with pytest.raises(StreamingQueryException):
        start(spark, root, fail).awaitTermination()
    point = resume_point(spark, f"{root}/checkpoint").first()
    assert (point["last_commit"], point["repeats_batch"]) == (1, 2)
    assert point["committed_position"] == '{"logOffset":1}' and point["planned_position"] == '{"logOffset":2}'
    audit = file_resume_audit(spark, f"{root}/checkpoint", f"{root}/topic")
    assert {r["state"]: r["n"] for r in audit.groupBy("state").agg(F.count("*").alias("n")).collect()} == {"read": 2, "repeats": 1}
    start(spark, root).awaitTermination()
    assert resume_point(spark, f"{root}/checkpoint").first()["repeats_batch"] is None
    first = file_resume_audit(spark, f"{root}/checkpoint", f"{root}/topic").where("batch_id = 0").first()["path"]
    os.remove(first.removeprefix("file:"))
    audit = file_resume_audit(spark, f"{root}/checkpoint", f"{root}/topic")
    assert sorted(r["state"] for r in audit.collect()) == ["archived", "read", "read"]


def test_no_checkpoint_yet(spark, tmp_path):
    land(spark, str(tmp_path), 1)
    assert offset_log(spark, str(tmp_path / "none")).count() == 0
    audit = file_resume_audit(spark, str(tmp_path / "none"), str(tmp_path / "topic"))
    assert [(r["state"], r["batch_id"]) for r in audit.collect()] == [("waiting", None)]


def write_log(folder, number, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / str(number)).write_text(text)


def test_broker_positions_against_what_the_broker_holds(spark, tmp_path):
    head = 'v1\n{"batchWatermarkMs":0,"batchTimestampMs":1783126880000,"conf":{}}\n'
    write_log(tmp_path / "offsets", 410, head + '{"info":{"0":270000},"status":{"0":10,"1":20,"2":30}}')
    write_log(tmp_path / "offsets", 411, head + '{"info":{"0":272492},"status":{"0":15,"1":25,"2":30}}')
    write_log(tmp_path / "offsets", 412, head + '{"info":{"0":272600},"status":{"0":19,"1":29,"2":31}}')
    for number in (410, 411):
        write_log(tmp_path / "commits", number, 'v1\n{"nextBatchWatermarkMs":0}')
    points = resume_point(spark, str(tmp_path))
    assert tuple(points.select("source", "last_commit", "repeats_batch").first()) == (0, 411, 412)
    at = topic_positions(points)
    held = spark.createDataFrame(
        [("info", 0, 0, 1500), ("status", 0, 12, 40), ("status", 1, 28, 40), ("status", 3, 0, 7)],
        "topic string, partition int, earliest long, latest long")
    found = {(r["topic"], r["partition"]): (r["state"], r["next_offset"], r["lost_messages"], r["waiting_messages"])
             for r in topic_resume_audit(at, held).collect()}
    assert found == {
        ("info", 0): ("reset", 272492, None, 1500), ("status", 0): ("resumes", 15, 0, 25), ("status", 1): ("lost range", 25, 3, 12),
        ("status", 2): ("gone", 30, None, None), ("status", 3): ("new", None, 0, 7)}
