import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import content_manifest, manifest_diff, table_checksum
from pulsegrid.plans.stations import INFO_FIELDS, INFO_PAYLOAD, STATUS_FIELDS, STATUS_PAYLOAD, WEATHER_FIELDS, WEATHER_PAYLOAD
from pulsegrid.session import scratch_path, shared_root
from pulsegrid.sources import (
    backup, bad_payloads, compact, drop_expired_partitions, envelope, export_csv, inventory, inventory_report,
    format_sizes, keyed_messages, mixed_folder, payload_columns, prune_versions, publish, published_versions, read_published, skipped_files, small_files,
    source_files, verify_copy,
)

T0 = dt.datetime(2026, 3, 2)


def data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith((".parquet", ".csv"))]


def raw(spark, *values):
    return spark.createDataFrame([(v, T0) for v in values], "value STRING, ingestion_ts TIMESTAMP")


def test_status_payload_is_permissive(spark, rows):
    good = ('{"stationcode":16107,"name":"n","is_installed":"OUI","numbikesavailable":12,"numdocksavailable":23,'
            '"mechanical":8,"ebike":4,"capacity":35,"nom_arrondissement_communes":"Paris"}')
    odd = '{"stationcode":"2","numbikesavailable":"7","numdocksavailable":3.7,"capacity":99999999999}'
    df = raw(spark, good, odd, "not json", None)
    got = rows(payload_columns(df, STATUS_PAYLOAD, STATUS_FIELDS), "stationcode", "numbikesavailable", "numdocksavailable", "capacity")
    assert got == [(None, None, None, None)] * 2 + [("16107", 12, 23, 35), ("2", None, None, None)]
    assert bad_payloads(df, STATUS_PAYLOAD, "stationcode").count() == 2


def test_nested_payloads(spark):
    info = payload_columns(raw(spark, '{"stationcode":"1","name":"n","capacity":5,"coordonnees_geo":{"lon":2.2,"lat":48.8}}'),
                           INFO_PAYLOAD, INFO_FIELDS).head()
    assert (info["latitude"], info["longitude"]) == (48.8, 2.2)
    weather = payload_columns(raw(spark, '{"main":{"temp":18.2,"humidity":60,"pressure":1},"wind":{"speed":3.1},"dt":17}'),
                              WEATHER_PAYLOAD, WEATHER_FIELDS).head()
    assert tuple(weather)[:4] == (18.2, 60, 3.1, 17)


def test_messages_without_key_column_value(spark, rows):
    df = spark.createDataFrame([("s1", 1), (None, 2)], "stationcode STRING, v INT")
    assert rows(keyed_messages(df, "stationcode", ["stationcode", "v"])) == [
        ("s1", '{"stationcode":"s1","v":1}'), ("unknown", '{"v":2}')]
    assert keyed_messages(df, None, ["v"]).where("key IS NULL").count() == 2


def test_envelope_casts_binary(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b"{}"), "t", T0)], "key BINARY, value BINARY, topic STRING, timestamp TIMESTAMP")
    out = envelope(df)
    assert out.columns == ["key", "value", "topic", "kafka_timestamp", "ingestion_ts"]
    assert (out.head()["key"], out.head()["value"]) == ("k", "{}") and out.head()["ingestion_ts"] is not None


def test_mixed_folder(spark, tmp_path):
    spark.range(3).select("id", F.lit("p").alias("only_parquet")).write.parquet(f"{tmp_path}/a")
    spark.range(2).select("id", F.lit(1.5).alias("only_csv")).write.option("header", True).csv(f"{tmp_path}/deep/b")
    out = mixed_folder(spark, str(tmp_path))
    assert out.count() == 5 and set(out.columns) == {"id", "only_parquet", "only_csv"}
    assert out.where("only_csv IS NULL").count() == 3
    files = source_files(out)
    assert files == sorted(files) and {f.rsplit(".", 1)[1] for f in files} == {"parquet", "csv"}
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        mixed_folder(spark, str(tmp_path / "none"))


def test_small_files_widen_types_and_skip_broken_ones(spark, tmp_path):
    spark.range(2).select(F.col("id").cast("int").alias("v")).coalesce(1).write.parquet(f"{tmp_path}/a")
    spark.range(2).select((F.col("id") + 3_000_000_000).alias("v")).coalesce(1).write.parquet(f"{tmp_path}/b")
    (tmp_path / "c.parquet").write_bytes(b"broken")
    out = small_files(spark, str(tmp_path), "v BIGINT, extra STRING")
    assert sorted(r["v"] for r in out.collect()) == [0, 1, 3_000_000_000, 3_000_000_001]
    gone = [r["path"] for r in skipped_files(spark, str(tmp_path), "v BIGINT, extra STRING").collect()]
    assert [os.path.basename(p) for p in gone] == ["c.parquet"]


@pytest.mark.parametrize("files", [None, 4])
def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path, files):
    many, few = f"{tmp_path}/many", f"{tmp_path}/few"
    spark.range(1000).select("id", (F.col("id") % 7).alias("g")).repartition(40).write.parquet(many)
    out = compact(spark, many, few, files=files)
    assert len(data_files(many)) == 40 and len(data_files(few)) == (files or 1)
    assert table_checksum(out).head() == table_checksum(spark.read.parquet(many)).head()
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "4096"      # the caller's session is untouched


def test_partitioned_compaction(spark, tmp_path):
    many, few = f"{tmp_path}/many", f"{tmp_path}/few"
    hot = F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 3)
    spark.range(1000).select("id", hot.alias("day")).repartition(20).write.parquet(many)
    out = compact(spark, many, few, partition_by=["day"])
    assert len(data_files(few)) <= 6
    assert sorted(map(tuple, out.select("id", "day").collect())) == sorted(map(tuple, spark.read.parquet(many).collect()))


def test_format_sizes(spark, tmp_path):
    got = {r["format"]: r for r in format_sizes(spark.range(5000).select("id", F.lit("some text").alias("t")).coalesce(1), str(tmp_path)).collect()}
    assert set(got) == {"json", "csv", "parquet"} and got["json"]["gain_over_json_pct"] == 0
    assert got["parquet"]["bytes_per_row"] < got["csv"]["bytes_per_row"] < got["json"]["bytes_per_row"]


def test_snapshots_follow_the_version_log(spark, tmp_path):
    root = f"{tmp_path}/curated"
    assert read_published(spark, root) is None
    assert publish(spark.range(3), root).rows_written == 3
    second = publish(spark.range(5), root)
    assert read_published(spark, root).count() == 5
    with pytest.raises(ValueError):
        publish(spark.range(0), root)
    assert read_published(spark, root).count() == 5
    # a snapshot may be derived from the current one
    publish(read_published(spark, root).union(spark.range(1)), root)
    assert read_published(spark, root).count() == 6
    assert published_versions(spark, root).count() == 3 and second.version in second.path
    assert second.version in prune_versions(spark, root, keep=1)
    assert not os.path.exists(second.path) and published_versions(spark, root).count() == 1
    assert read_published(spark, root).count() == 6


def test_csv_export(spark, tmp_path):
    export_csv(spark.range(10).repartition(3), f"{tmp_path}/many")
    export_csv(spark.range(10).repartition(3), f"{tmp_path}/one", single_file=True)
    assert len(data_files(f"{tmp_path}/many")) == 3 and len(data_files(f"{tmp_path}/one")) == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/one").columns == ["id"]


def test_retention_drops_whole_days(spark):
    days = [("2026-01-01", 1), ("2026-01-30", 2), ("2026-02-01", 3), ("2026-03-02", 4)]
    spark.sql("DROP TABLE IF EXISTS raw_days")
    path = scratch_path(spark, "raw-days")
    spark.createDataFrame(days, "ingest_date STRING, v INT").write.partitionBy("ingest_date").option("path", path).saveAsTable("raw_days")
    assert drop_expired_partitions(spark, "raw_days", "2026-03-02", 30) == ["2026-01-01", "2026-01-30"]
    assert sorted(r["v"] for r in spark.table("raw_days").collect()) == [3, 4]
    spark.sql("DROP TABLE raw_days")


def test_inventory(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(f"{tmp_path}/clean")
    os.makedirs(f"{tmp_path}/clean/_checkpoint")
    with open(f"{tmp_path}/clean/_checkpoint/0", "w") as f:
        f.write("x" * 50)
    listing = inventory(spark, {"clean": f"{tmp_path}/clean", "technical": f"{tmp_path}/clean/_checkpoint"})
    report = {(r["zone"], r["kind"]): r for r in inventory_report(listing).collect()}
    assert report["clean", "parquet"]["objects"] == 4 and report["technical", "checkpoint"]["bytes"] == 50
    assert report["clean", "parquet"]["usd_per_month"] > 0


def test_backup_is_verified(spark, tmp_path):
    source, target = f"{tmp_path}/zone", f"{tmp_path}/backup"
    spark.range(50).select("id", F.lit("x").alias("t")).write.parquet(source)
    assert [r["state"] for r in backup(spark, source, target).collect()] == ["same"]
    short = spark.read.parquet(target).where("id < 49")
    assert [r["state"] for r in verify_copy(spark.read.parquet(source), short).collect()] == ["changed"]


def test_manifest_by_file(spark, tmp_path):
    spark.range(40).repartition(4).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    manifest = content_manifest(table, F.col("_metadata.file_name"), ["id"], F.col("_metadata.file_size"))
    assert manifest.count() == 4 and manifest.where("bytes > 0").count() == 4
    assert manifest_diff(manifest, manifest).where("state = 'same'").count() == 4


def test_shared_folder_comes_from_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_root(spark) == (configured or spark.conf.get("pulsegrid.shared.dir")).rstrip("/")
    assert scratch_path(spark, "x").startswith(f"{shared_root(spark)}/x-")
