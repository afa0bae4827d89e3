import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.__main__ import main
from pulsegrid.operators import stalls
from pulsegrid.sources import parquet_stream, publish, read_published
from pulsegrid.sources.messages import ENVELOPE
from pulsegrid.streaming.jobs import KEPT_VERSIONS
from pulsegrid.streaming import (
    JobFolders, clean_status, clean_weather, progress_rows, run_curation, start_append, start_curated, start_raw,
    start_reference, start_station_raw,
)

T0 = dt.datetime(2026, 3, 2, 8)
TOPIC = "key BINARY, value BINARY, topic STRING, timestamp TIMESTAMP"
CLEAN_STATUS = ("stationcode STRING, numbikesavailable INT, numdocksavailable INT, mechanical INT, ebike INT, capacity INT, "
                "nom_arrondissement_communes STRING, ingestion_ts TIMESTAMP")


def at(m):
    return T0 + dt.timedelta(minutes=m)


def land(spark, folder, *messages):
    """Append one file of broker records: (payload, minute)."""
    rows = [(bytearray(b"k"), bytearray(json.dumps(p).encode() if not isinstance(p, str) else p.encode()), "t", at(m)) for p, m in messages]
    spark.createDataFrame(rows, TOPIC).coalesce(1).write.mode("append").parquet(folder)


def status(code, bikes, capacity=20):
    return {"stationcode": code, "numbikesavailable": bikes, "numdocksavailable": 1, "mechanical": 1, "ebike": 1,
            "capacity": capacity, "nom_arrondissement_communes": "Paris"}


def folders(root, name):
    return JobFolders(f"{root}/{name}", f"{root}/{name}-checkpoint")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def to_clean(spark, root, **options):
    drain(start_raw(parquet_stream(spark, f"{root}/topic", TOPIC, 1), folders(root, "raw"), every=None))
    rows = clean_status(parquet_stream(spark, f"{root}/raw", ENVELOPE, 1), **options)
    return drain(start_append(rows, folders(root, "clean"), every=None))


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    root = str(tmp_path)
    for m in range(3):
        land(spark, f"{root}/topic", (status("s1", m), m), (status("s2", m), m))
    to_clean(spark, root)
    assert spark.read.parquet(f"{root}/clean").count() == 6
    land(spark, f"{root}/topic", (status("s1", 2), 2), (status("s1", 3), 3))      # first one is a repeat
    land(spark, f"{root}/topic", (status("s2", 4), 4))
    query = to_clean(spark, root)
    clean = spark.read.parquet(f"{root}/clean")
    assert clean.count() == 8 and clean.select("stationcode", "numbikesavailable").distinct().count() == 8
    progress = progress_rows(spark, query)
    assert progress.count() >= 1 and stalls(progress, ["query"], "committed_at", 2100).count() == 0
    to_clean(spark, root)                                                           # nothing new
    assert spark.read.parquet(f"{root}/clean").count() == 8


def test_late_messages_are_kept(spark, tmp_path):
    root = str(tmp_path)
    for code, minute in (("s1", 300), ("s2", 500), ("s3", 60), ("s1", 300)):        # three hours late, then a repeat
        land(spark, f"{root}/topic", (status(code, 1), minute))
        to_clean(spark, root)
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/clean").select("stationcode").collect()) == ["s1", "s2", "s3"]


def test_by_ingestion_folds_a_micro_batch(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/topic", (status("s1", 1), 0), (status("s1", 2), 1), ("broken", 1))
    to_clean(spark, root, by_ingestion=True)
    clean = spark.read.parquet(f"{root}/clean")
    # one micro-batch has one ingestion time: two messages of a station fold into one
    assert clean.where("stationcode = 's1'").count() == 1 and clean.where("stationcode IS NULL").count() == 1


def test_retention_of_what_the_raw_job_wrote(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/topic", (status("s1", 1), 0))
    for q in start_station_raw(lambda kind: parquet_stream(spark, f"{root}/topic", TOPIC), f"{root}/raw", every=None):
        drain(q)
    days = {p.name for p in (tmp_path / "raw" / "weather").iterdir() if p.name.startswith("ingest_date")}
    assert len(days) == 1
    assert main(["retain", "--raw", f"{root}/raw", "--days", "0", "--today", "2000-01-01"]) == 0
    assert (tmp_path / "raw" / "weather" / days.copy().pop()).exists()
    assert main(["retain", "--raw", f"{root}/raw", "--days", "30", "--today", "2100-01-01"]) == 0
    assert not any((tmp_path / "raw" / kind / day).exists() for kind in ("weather", "station_status") for day in days)


def test_published_states_do_not_pile_up(spark, tmp_path):
    root = str(tmp_path)
    info = {"stationcode": "s1", "name": "n", "capacity": 5, "coordonnees_geo": {"lon": 2.0, "lat": 48.0}}
    for m in range(9):
        land(spark, f"{root}/topic", (dict(info, name=str(m)), m))
    drain(start_raw(parquet_stream(spark, f"{root}/topic", TOPIC, 1), folders(root, "raw"), every=None))
    drain(start_reference(parquet_stream(spark, f"{root}/raw", ENVELOPE, 1), f"{root}/info", f"{root}/info-checkpoint", every=None))
    assert len([p for p in (tmp_path / "info").iterdir() if p.name.startswith("version=")]) == KEPT_VERSIONS
    assert read_published(spark, f"{root}/info").count() == 1


def test_weather_is_kept_once_per_observation(spark, tmp_path):
    root = str(tmp_path)
    w = {"main": {"temp": 1.5, "humidity": 50, "pressure": 1}, "wind": {"speed": 2.0}, "dt": 77}
    land(spark, f"{root}/topic", (w, 0), (w, 10), (dict(w, dt=78), 20))
    drain(start_raw(parquet_stream(spark, f"{root}/topic", TOPIC), folders(root, "raw"), every=None, by_date=True))
    assert "ingest_date" in spark.read.parquet(f"{root}/raw").columns
    drain(start_append(clean_weather(parquet_stream(spark, f"{root}/raw", ENVELOPE)), folders(root, "weather"), every=None))
    assert sorted(r["weather_ts"] for r in spark.read.parquet(f"{root}/weather").collect()) == [77, 78]


@pytest.mark.parametrize("first_wins,name", [(False, "new"), (True, "old")])
def test_reference_versions(spark, tmp_path, first_wins, name):
    root = str(tmp_path)

    def info(n):
        return {"stationcode": "s1", "name": n, "capacity": 5, "coordonnees_geo": {"lon": 2.0, "lat": 48.0}}

    for label, minute in (("old", 0), ("new", 5)):
        land(spark, f"{root}/topic", (info(label), minute))
        drain(start_raw(parquet_stream(spark, f"{root}/topic", TOPIC), folders(root, "raw"), every=None,
                        ingested_at=F.col("timestamp")))
        drain(start_reference(parquet_stream(spark, f"{root}/raw", ENVELOPE), f"{root}/info", f"{root}/info-checkpoint",
                              every=None, first_wins=first_wins))
    out = spark.read.parquet(f"{root}/info") if first_wins else read_published(spark, f"{root}/info")
    assert [r["name"] for r in out.collect()] == [name]


def test_curated_follows_the_stream(spark, tmp_path):
    root = str(tmp_path)
    info = spark.createDataFrame([("s1", "One", 1.0, 2.0, at(0))], "stationcode STRING, name STRING, latitude DOUBLE, longitude DOUBLE, ingestion_ts TIMESTAMP")
    weather = spark.createDataFrame([], "temperature DOUBLE, humidity INT, wind_speed DOUBLE, weather_ts INT, ingestion_ts TIMESTAMP")

    def step(*rows):
        spark.createDataFrame([(c, b, 1, 1, 1, 20, "Paris", at(m)) for c, b, m in rows], CLEAN_STATUS).write.mode("append").parquet(f"{root}/clean")
        drain(start_curated(spark.readStream.schema(CLEAN_STATUS).parquet(f"{root}/clean"), lambda: info, lambda: weather,
                            f"{root}/state", f"{root}/curated", f"{root}/cp", every=None))
        return {r["stationcode"]: r["taux_occupation"] for r in read_published(spark, f"{root}/curated").collect()}

    assert step(("s1", 5, 0), ("s2", 10, 0)) == {"s1": 25.0, "s2": 50.0}
    assert step(("s1", 10, 1), ("s1", 1, -5)) == {"s1": 50.0, "s2": 50.0}


def test_curation_loop_survives_a_failing_round(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("source not there")
        return spark.range(len(calls))

    assert run_curation(build, f"{tmp_path}/snap", interval_seconds=0, rounds=3) == 2
    assert read_published(spark, f"{tmp_path}/snap").count() == 3


def test_empty_snapshot_is_not_published(spark, tmp_path):
    publish(spark.range(1), f"{tmp_path}/snap")
    assert run_curation(lambda: spark.range(0), f"{tmp_path}/snap", 0, 1) == 0
    assert read_published(spark, f"{tmp_path}/snap").count() == 1


def test_jobs_from_messages_to_csv(spark, tmp_path):
    root = str(tmp_path)
    info = {"stationcode": "s1", "name": "One", "capacity": 20, "coordonnees_geo": {"lon": 2.0, "lat": 48.0}}
    weather = {"main": {"temp": 9.5, "humidity": 50, "pressure": 1}, "wind": {"speed": 2.0}, "dt": 77}
    for m in range(3):
        land(spark, f"{root}/topics/station_status", (status("s1", m), m), (status("s2", 4 + m), m))
        land(spark, f"{root}/topics/station_information", (info, m))
        land(spark, f"{root}/topics/weather", (weather, m))
    assert main(["export", f"--curated={root}/curated", f"--target={root}/none"]) == 1
    for q in start_station_raw(lambda kind: parquet_stream(spark, f"{root}/topics/{kind}", TOPIC), f"{root}/raw", every=None):
        drain(q)
    assert main(["clean", f"--raw={root}/raw", f"--clean={root}/clean", "--once"]) == 0
    assert main(["curate", f"--clean={root}/clean", f"--curated={root}/curated", "--interval=0", "--rounds=1"]) == 0
    assert main(["export", f"--curated={root}/curated", f"--target={root}/csv", "--single-file"]) == 0
    assert main(["follow", f"--clean={root}/clean", f"--curated={root}/live", "--once"]) == 0
    batch, live = (read_published(spark, f"{root}/{n}").drop("date_calcul") for n in ("curated", "live"))
    assert sorted(map(str, live.collect())) == sorted(map(str, batch.collect()))
    got = {r["stationcode"]: r for r in spark.read.option("header", True).csv(f"{root}/csv").collect()}
    assert set(got) == {"s1", "s2"} and got["s1"]["name"] == "One" and got["s1"]["meteo_temp"] == "9.5"
    assert main(["compact", f"--source={root}/clean/station_status", f"--target={root}/compacted", "--files=1"]) == 0
    assert spark.read.parquet(f"{root}/compacted").count() == 6
