"""The exact clean job: late repeats, bad records, replayed batches, filters that read only what they must."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pulsegrid.streaming import ExactSpec, apply_batch, read_exact, start_exact

SCHEMA = "station STRING, ts TIMESTAMP, v INT"
T0 = dt.datetime(2026, 3, 2)


def message(i):
    return (f"s{i % 5}", T0 + dt.timedelta(hours=i), i)


def test_repeats_and_replays(spark, tmp_path):
    spec = ExactSpec(str(tmp_path / "z"), ["station"], "ts", F.col("station").isNotNull(), cuts=2, pages=1)
    draw, sent = random.Random(3), []
    for number in range(4):
        rows = [message(i) for i in range(number * 6, number * 6 + 6)] + [(None, None, -number)]
        rows += draw.sample(sent, min(len(sent), 4)) + rows[:2]              # late repeats and repeats within
        sent += rows[:6]
        batch = spark.createDataFrame(rows, SCHEMA)
        apply_batch(batch, number, spec)
        if number == 2:
            apply_batch(batch, number, spec)                                   # a replay
    assert sorted(r["v"] for r in read_exact(spark, spec).collect()) == list(range(24))
    assert sorted(r["v"] for r in read_exact(spark, spec, "bad").collect()) == [-3, -2, -1, 0]
    counts = read_exact(spark, spec, "counts").agg(*[F.sum(c) for c in ("n_read", "n_good", "n_bad", "n_clean", "n_repeated")]).first()
    assert counts[0] == counts[1] + counts[2] and tuple(counts[2:]) == (4, 24, 3 * 4 + 4 * 2)
    # a batch that failed before its counts is not read
    apply_batch(spark.createDataFrame([message(99)], SCHEMA), 4, spec)
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{spec.root}/counts/batch=4")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
    assert read_exact(spark, spec).count() == 24


def test_stream_resumes_without_state(spark, tmp_path):
    source, spec = str(tmp_path / "in"), ExactSpec(str(tmp_path / "out"), ["station"], "ts", F.col("station").isNotNull(), cuts=1, pages=1)
    for start in (0, 3):
        spark.createDataFrame([message(i) for i in range(start, start + 6)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = start_exact(spark.readStream.schema(SCHEMA).parquet(source), spec, every=None)
        query.awaitTermination()
        assert all(not p.stateOperators for p in query.recentProgress)
    assert sorted(r["v"] for r in read_exact(spark, spec).collect()) == list(range(9))
