"""Compaction beside a writer, tables of mixed types, look-ups through file ranges."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.sources import (
    Compaction, compact_live, drop_replaced, file_ranges, file_types, first_fit, live_files, manifest, promoted_schema, read_live,
    read_promoted, read_range, unreadable, wider, write_sorted,
)


def naive_first_fit(sizes, room):
    free, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, left in enumerate(free) if left >= sizes[i]), len(free))
        if at == len(free):
            free.append(room)
        free[at] -= sizes[i]
        out[i] = at
    return [out[i] for i in range(len(sizes))]


def test_first_fit_decreasing():
    draw = random.Random(1)
    for _ in range(100):
        sizes = [draw.randint(0, 50) for _ in range(draw.randint(0, 40))]
        assert first_fit(sizes, 50) == naive_first_fit(sizes, 50)


def names(frame):
    return sorted(os.path.basename(r["path"]) for r in frame.collect())


def test_only_small_files_are_rewritten_and_generations_follow(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(100_000).coalesce(1).write.parquet(root)                     # a large file
    big = names(live_files(spark, root))
    spark.range(100_000, 100_100).repartition(8).write.mode("append").parquet(root)
    done = compact_live(spark, root, target_bytes=100_000, small_bytes=50_000).first()
    assert (done["files_replaced"], done["files_added"]) == (8, 1)
    assert big[0] in names(live_files(spark, root)) and len(names(live_files(spark, root))) == 2
    assert compact_live(spark, root, target_bytes=100_000, small_bytes=50_000) is None      # one small file alone
    spark.range(100_100, 100_200).repartition(4).write.mode("append").parquet(root)
    done = compact_live(spark, root, target_bytes=100_000, small_bytes=50_000).first()
    assert (done["generation"], done["files_replaced"]) == (2, 4)                          # table files; the compacted one lies elsewhere
    rows = read_live(spark, root)
    assert rows.count() == 100_200 and rows.select(F.sum("id")).first()[0] == sum(range(100_200))
    assert drop_replaced(spark, root, upto=2) == 12
    assert read_live(spark, root).count() == 100_200


def test_partitions_and_names_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(60).select("id", F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 3).cast("int")).alias("day"))
    for part in range(3):
        rows.where(F.col("id") % 5 % 3 == part).repartition(2).write.partitionBy("day").mode("append").parquet(root)
    before = sorted(map(tuple, read_live(spark, root).select("id", "day").collect()))
    assert compact_live(spark, root).first()["files_added"] == 3             # one for each day
    assert sorted(map(tuple, read_live(spark, root).select("id", "day").collect())) == before
    assert read_live(spark, root).columns == ["id", "day"]


def test_of_two_compactions_the_second_fails_and_given_up_attempts_leave_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(50).repartition(5).write.parquet(root)
    Compaction(spark, root).rewrite()                                        # never published
    first, second = Compaction(spark, root), Compaction(spark, root)
    first.rewrite()
    second.rewrite()
    first.publish()
    with pytest.raises(RuntimeError):
        second.publish()
    assert read_live(spark, root).count() == 50 and manifest(spark, root).count() == 6


def test_compaction_beside_a_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def feed(start):
        spark.range(start, start + 20).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id LONG").option("maxFilesPerTrigger", 1).parquet(source)
        stream.writeStream.option("checkpointLocation", f"{sink}-checkpoint").trigger(availableNow=True).start(sink).awaitTermination()

    feed(0)
    job = Compaction(spark, sink)
    assert job.rewrite() >= 2
    feed(20)
    job.publish()
    feed(40)
    assert sorted(r["id"] for r in read_live(spark, sink).collect()) == list(range(60))
    drop_replaced(spark, sink, upto=1)
    assert read_live(spark, sink).count() == 60


def test_types_are_joined():
    assert [wider(a, b) for a, b in (("int", "int"), ("int", "bigint"), ("bigint", "double"), ("double", "string"), ("date", "int"),
                                     ("decimal(9,2)", "int"), ("date", "timestamp_ntz"), ("boolean", "bigint"))] == [
        "int", "bigint", "double", "string", "string", "double", "timestamp_ntz", "string"]
    kinds = ["int", "bigint", "float", "double", "string", "date", "timestamp", "timestamp_ntz", "boolean", "decimal(5,1)"]
    for a in kinds:
        for b in kinds:
            assert wider(a, b) == wider(b, a)


def test_mixed_types_broken_files_and_missing_columns(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT 1 AS a, 'x' AS s").write.parquet(f"{root}/one")
    spark.sql("SELECT CAST(3000000000 AS BIGINT) AS a").write.parquet(f"{root}/two")
    spark.sql("SELECT 2.5D AS a, 7 AS s").write.parquet(f"{root}/three")
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 broken")
    (tmp_path / "empty.parquet").write_bytes(b"")
    (tmp_path / "cut.parquet").write_bytes(b"x" * 40 + b"\xff\xff\xff\x7fPAR1")
    types = file_types(spark, root)
    assert promoted_schema(types) == {"a": "double", "s": "string"}
    out = read_promoted(spark, root)
    assert out.dtypes == [("a", "double"), ("s", "string")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1.0, "x"), (3e9, None), (2.5, "7")], key=str)
    assert names(unreadable(spark, root)) == ["bad.parquet", "cut.parquet"]          # Spark lists no empty files
    assert read_promoted(spark, root, {"a": "bigint"}).dtypes == [("a", "bigint")]
    only = tmp_path / "none"
    only.mkdir()
    (only / "bad.parquet").write_bytes(b"")
    with pytest.raises(FileNotFoundError):
        read_promoted(spark, str(only))


def test_look_ups_open_only_files_that_may_hold_the_rows(spark, tmp_path):
    root = str(tmp_path / "s")
    rows = spark.range(4000).select((F.col("id") * 7 % 1000).alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"), F.lit("p").alias("p"))
    index = write_sorted(rows, root, ["k", "ts"], 10)
    assert index.count() == 10 and index.agg(F.sum("n_rows")).first()[0] == 4000
    found = read_range(spark, root, k=(100, 120))
    assert found.files_opened <= 2 and found.files == 10
    assert sorted(map(tuple, found.rows.collect())) == sorted(map(tuple, rows.where("k BETWEEN 100 AND 120").collect()))
    assert read_range(spark, root, k=(5000, None)).rows.count() == 0
    late = read_range(spark, root, ts=(dt.datetime(1970, 1, 1, 1), None))
    assert late.rows.count() == rows.where("ts >= TIMESTAMP '1970-01-01 01:00:00'").count()
    assert "PushedFilters: [IsNotNull(k)" in found.rows._jdf.queryExecution().executedPlan().toString()


def test_files_without_ranges_are_always_opened(spark, tmp_path):
    root = str(tmp_path / "s")
    spark.createDataFrame([(None, 1)], "k INT, v INT").coalesce(1).write.parquet(root)
    assert tuple(file_ranges(spark, root, ["k"]).select("min_k", "max_k").first()) == (None, None)
    spark.createDataFrame([(5, 1), (None, 2)], "k INT, v INT").coalesce(1).write.mode("append").parquet(root)
    assert sorted(map(tuple, file_ranges(spark, root, ["k"]).select("min_k", "max_k").collect()), key=str) == [(5, 5), (None, None)]


def test_rewrite_sorts_no_rows(spark, tmp_path):
    from pulsegrid.sources.generations import _unsorted

    name, root = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "t")
    before = spark.conf.get(name)
    with _unsorted(spark):
        assert int(spark.conf.get(name)) > 0                  # Spark plans no sort for such a write
    spark.range(100).withColumn("p", F.col("id") % 2).repartition(3).write.partitionBy("p").parquet(root)
    compact_live(spark, root)
    assert spark.conf.get(name) == before
    assert live_files(spark, root).count() == 2 and sorted(r["id"] for r in read_live(spark, root).collect()) == list(range(100))
