"""Stored tables: snapshots, compaction, exports, retention and backups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from pulsegrid.operators.audit import content_manifest, manifest_diff

from .files import inventory

_LOG_SCHEMA = "version STRING, n_rows BIGINT, published_at TIMESTAMP"


class Published(NamedTuple):
    version: str
    rows_written: int
    rows_reread: int
    path: str


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}-versions"


def _version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def publish(df: DataFrame, root: str, version: str | None = None, allow_empty: bool = False) -> Published:
    """Write a new snapshot of a table and make it current.

    Every snapshot has its own folder and readers follow an append-only log of published
    versions, so nobody sees a half-written table.  The row count is observed during the
    write (no second evaluation), compared with a re-read, and an empty or short snapshot is
    never made current.
    """
    spark = df.sparkSession
    version = version or datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S-%f")
    target = _version_path(root, version)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    written = int(seen.get["n"])
    if written == 0 and not allow_empty:
        raise ValueError(f"refusing to publish an empty snapshot of {root}")
    reread = spark.read.parquet(target).count()
    if reread != written:
        raise RuntimeError(f"snapshot {target} has {reread} rows, {written} were written")
    entry = spark.range(1).select(
        F.lit(version).alias("version"), F.lit(written).cast("bigint").alias("n_rows"),
        F.current_timestamp().alias("published_at"),
    )
    entry.write.mode("overwrite").json(f"{_log_path(root)}/{version}")
    return Published(version, written, reread, target)


def published_versions(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_LOG_SCHEMA).option("recursiveFileLookup", "true").json(_log_path(root))


def read_published(spark: SparkSession, root: str) -> DataFrame | None:
    """The current snapshot, or None before the first publication."""
    try:
        newest = published_versions(spark, root).agg(F.max_by("version", F.struct("published_at", "version"))).head()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if newest is None or newest[0] is None else spark.read.parquet(_version_path(root, newest[0]))


def prune_versions(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete all but the newest ``keep`` snapshots with their log entries; returns the versions gone.

    Keep enough of them for the longest-running reader.
    """
    old = [
        row["version"]
        for row in published_versions(spark, root).orderBy(F.col("published_at").desc(), F.col("version").desc())
        .select("version").collect()[keep:]
    ]
    for version in old:
        # the log entry goes first, so no reader is sent to a half-deleted snapshot
        for folder in (f"{_log_path(root)}/{version}", _version_path(root, version)):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return old


def compact(
    spark: SparkSession, source: str, target: str, *, files: int | None = None,
    target_bytes: int = 512 * 1024 * 1024, partition_by: Sequence[str] = (),
) -> DataFrame:
    """Rewrite many small Parquet files as few larger ones with identical rows; returns the copy.

    By default nothing is shuffled: small files are packed into read tasks of ``target_bytes``
    and every task writes one file.  ``files`` asks for an exact number and costs a shuffle; so
    does ``partition_by``, where adaptive execution splits a hot partition over several tasks
    and puts small ones together.
    """
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    packing.conf.set("spark.sql.files.openCostInBytes", "4096")
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    packed = packing.read.parquet(source)
    if files:
        packed = packed.repartition(files)
    elif partition_by:
        packing.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
        packed = packed.hint("rebalance", *partition_by)
    writer = packed.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return spark.read.parquet(target)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header.  ``single_file`` pulls all rows through one task: small exports only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def split_retention(df: DataFrame, ts: str, now: Column, keep_days: int = 30) -> DataFrame:
    """Mark rows as expired once they are older than ``keep_days``."""
    return df.withColumn("expired", F.col(ts) < now - F.make_dt_interval(days=F.lit(keep_days)))


def drop_expired_partitions(spark: SparkSession, table: str, today: str, keep_days: int = 30,
                            column: str = "ingest_date") -> list[str]:
    """Drop whole date partitions older than the retention period from a catalogue table.

    Kept data is not rewritten.  Only the partition list (one short line per day) is looked at.
    """
    oldest = F.date_sub(F.to_date(F.lit(today)), keep_days)
    dates = (
        spark.sql(f"SHOW PARTITIONS {table}")
        .select(F.regexp_extract("partition", rf"{column}=([^/]+)", 1).alias("d"))
        .where((F.col("d") != "") & (F.to_date("d") < oldest))
        .distinct()
    )
    gone = sorted(row["d"] for row in dates.toLocalIterator())
    for day in gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{day}')")
    return gone


def retain_days(spark: SparkSession, root: str, today: str, keep_days: int = 30, column: str = "ingest_date") -> list[str]:
    """Delete the date folders of a table that are older than the retention period; returns the dates gone.

    Only folder names are looked at, one per day; kept data is not rewritten.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    oldest = date.fromisoformat(today) - timedelta(days=keep_days)
    gone = []
    for status in files.listStatus(folder):
        name, _, day = status.getPath().getName().partition("=")
        if name == column and _is_date(day) and date.fromisoformat(day) < oldest:
            files.delete(status.getPath(), True)
            gone.append(day)
    return sorted(gone)


def _is_date(text: str) -> bool:
    try:
        date.fromisoformat(text)
    except ValueError:
        return False
    return True


def backup(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a table and return the comparison of original and copy."""
    spark.read.parquet(source).write.mode("overwrite").parquet(target)
    return verify_copy(spark.read.parquet(source), spark.read.parquet(target))


def verify_copy(original: DataFrame, copy: DataFrame, by: Column | None = None) -> DataFrame:
    """Manifest comparison of two tables, per value of ``by`` (default: the table as a whole)."""
    group = F.lit("all") if by is None else by
    columns = original.columns
    return manifest_diff(
        content_manifest(original, group, columns), content_manifest(copy.select(*columns), group, columns)
    )


def format_sizes(df: DataFrame, root: str, formats: Sequence[str] = ("json", "csv", "parquet")) -> DataFrame:
    """Write the same rows in several formats and compare bytes per row and the gain over JSON."""
    spark = df.sparkSession
    for name in formats:
        writer = df.write.mode("overwrite").format(name)
        (writer.option("header", "true") if name == "csv" else writer).save(f"{root.rstrip('/')}/{name}")
    sizes = (
        inventory(spark, {name: f"{root.rstrip('/')}/{name}" for name in formats})
        .groupBy(F.col("zone").alias("format")).agg(F.sum("bytes").alias("bytes"))
    )
    rows = spark.read.parquet(f"{root.rstrip('/')}/parquet").agg(F.count(F.lit(1))).scalar()
    json_bytes = sizes.where(F.col("format") == "json").select("bytes").scalar()
    return sizes.withColumns({
        "bytes_per_row": F.try_divide(F.col("bytes"), rows),
        "gain_over_json_pct": (F.lit(1) - F.col("bytes") / json_bytes) * 100,
    })
