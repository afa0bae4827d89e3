"""Files: mixed folders, many small files, inventories and alert logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_PARQUET = "*.[pP][aA][rR][qQ][uU][eE][tT]"
_CSV = "*.[cC][sS][vV]"

# Shape of one line of the alert log.
ALERT_LINE = (
    "received_at STRING, payload STRUCT<alerts: ARRAY<STRUCT<"
    "status: STRING, labels: STRUCT<alertname: STRING, severity: STRING, composant: STRING>>>>"
)


def mixed_folder(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All Parquet and CSV files below ``path`` as one table with the union of their columns.

    With a declared schema nothing is inferred; without one, CSV types are inferred.  The file
    each row came from is in the hidden column ``_metadata.file_path`` (see
    :func:`source_files`).  Fails if the folder holds neither kind.
    """
    parts = []
    for kind, glob, options in (("parquet", _PARQUET, {}), ("csv", _CSV, {"header": "true"})):
        reader = spark.read.format(kind).options(recursiveFileLookup="true", pathGlobFilter=glob, **options)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
        try:
            part = reader.load(path)
        except AnalysisException as problem:
            if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":       # no file of this kind
                raise
            continue
        if part.inputFiles():
            parts.append(part)
    if not parts:
        raise FileNotFoundError(f"no Parquet or CSV file below {path}")
    table = parts[0]
    for other in parts[1:]:
        table = table.unionByName(other, allowMissingColumns=True)
    return table


def source_files(df: DataFrame) -> list[str]:
    """Sorted list of the files behind a file-based table (metadata only, no data is read)."""
    return sorted(df.inputFiles())


def small_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Many small Parquet files with slightly different types as one table.

    The declared schema is the wider one (BIGINT where some files hold INT); unreadable files
    are skipped, see :func:`skipped_files`.
    """
    return (
        spark.read.schema(schema)
        .option("ignoreCorruptFiles", "true")
        .option("recursiveFileLookup", "true")
        .parquet(path)
    )


def skipped_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Paths of the Parquet files below ``path`` that :func:`small_files` takes no row from."""
    def plain(column: str):
        return F.regexp_replace(F.col(column), "^([a-z0-9]+):/+", "$1:/")          # one spelling of the root

    present = inventory(spark, {"": path}).where(F.col("path").rlike(r"(?i)\.parquet$")).select(plain("path").alias("path"))
    read = small_files(spark, path, schema).select(F.col("_metadata.file_path").alias("file")).distinct()
    return present.join(read.select(plain("file").alias("path")), "path", "left_anti")


def inventory(spark: SparkSession, roots: Mapping[str, str], gone_too: bool = False) -> DataFrame:
    """Objects below each root: zone, path, bytes, modification time.  Contents are not read.

    A file that a stream's log still names but that is gone is an error, or left out with ``gone_too``.

    Names starting with ``_`` or ``.`` are hidden from a scan; pass a checkpoint or metadata
    folder as a root of its own to see it.
    """
    listing = None
    for zone, root in roots.items():
        part = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", gone_too).load(root)
            .select(F.lit(zone).alias("zone"), "path", F.col("length").alias("bytes"), "modificationTime")
        )
        listing = part if listing is None else listing.unionByName(part)
    return listing


def inventory_report(listing: DataFrame, usd_per_gb_month: float = 0.024) -> DataFrame:
    """Bytes, objects, mean size and monthly price per zone and kind of object."""
    kind = (
        F.when(F.col("path").contains("_checkpoint"), "checkpoint")
        .when(F.col("path").contains("_spark_metadata"), "metadata")
        .when(F.col("path").rlike(r"(?i)\.parquet$"), "parquet")
        .otherwise("other")
    )
    return (
        listing.groupBy("zone", kind.alias("kind"))
        .agg(F.count(F.lit(1)).alias("objects"), F.sum("bytes").alias("bytes"))
        .withColumn("mean_bytes", F.col("bytes") / F.col("objects"))
        .withColumn("usd_per_month", F.col("bytes") / F.lit(1024.0**3) * usd_per_gb_month)
    )


def alert_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON log lines as one row per alert."""
    line = F.from_json(F.col(value), ALERT_LINE)
    return (
        lines.select(line.alias("l"))
        .select(F.to_timestamp("l.received_at").alias("received_at"), F.explode("l.payload.alerts").alias("a"))
        .select("received_at", F.col("a.status").alias("status"), "a.labels.*")
    )
