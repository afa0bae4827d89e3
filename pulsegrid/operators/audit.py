"""Fingerprints and comparisons of data sets: checksums, manifests, delivery and recovery audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions import digest_sum, row_digest


def table_checksum(df: DataFrame, columns: Sequence[Column | str] | None = None) -> DataFrame:
    """Row count and order-free SHA-256 fingerprint as one row.

    Rows are hashed where they are and only partial sums travel; file layout does not matter.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        digest_sum(row_digest(columns or df.columns)).alias("checksum"),
    )


def content_manifest(
    df: DataFrame, path: Column, columns: Sequence[Column | str] | None = None, size: Column | None = None
) -> DataFrame:
    """One line per object: ``path``, rows, bytes and fingerprint of its rows.

    ``path`` may be ``_metadata.file_path`` or any grouping expression.  Objects of any size
    work because their rows are never gathered.
    """
    return df.groupBy(path.alias("path")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.max(size) if size is not None else F.sum(F.lit(0))).cast("bigint").alias("bytes"),
        digest_sum(row_digest(columns or df.columns)).alias("checksum"),
    )


def manifest_diff(original: DataFrame, copy: DataFrame, path: str = "path", checksum: str = "checksum",
                  size: str = "n_rows") -> DataFrame:
    """State of every object after a restore: same, changed, missing or unexpected.

    Both manifests are stacked and folded by path: one exchange, no join.
    """
    sides = original.select(path, checksum, size, F.lit(True).alias("_o")).unionByName(
        copy.select(path, checksum, size, F.lit(False).alias("_o"))
    )
    left, right = F.col("_o"), ~F.col("_o")
    return (
        sides.groupBy(path)
        .agg(
            F.max(F.when(left, F.col(checksum))).alias("_ca"),
            F.max(F.when(right, F.col(checksum))).alias("_cb"),
            F.max(F.when(left, F.col(size))).alias("original_size"),
            F.max(F.when(right, F.col(size))).alias("copy_size"),
        )
        .select(
            path,
            "original_size",
            "copy_size",
            F.when(F.col("_cb").isNull(), "missing")
            .when(F.col("_ca").isNull(), "unexpected")
            .when(F.col("_ca") == F.col("_cb"), "same")
            .otherwise("changed")
            .alias("state"),
        )
    )


def recovery_point(diff: DataFrame) -> DataFrame:
    """What a restore lost: objects and size that are missing or differ, computed rather than assumed."""
    lost = F.col("state").isin("missing", "changed")
    return diff.agg(
        F.count_if(F.col("state") != "unexpected").alias("objects_expected"),
        F.count_if(F.col("state") == "same").alias("objects_intact"),
        F.count_if(lost).alias("objects_lost"),
        F.coalesce(F.sum(F.when(lost, F.col("original_size"))), F.lit(0)).cast("bigint").alias("size_lost"),
    )


def delivery_audit(expected: DataFrame, consumed: DataFrame, message: str) -> DataFrame:
    """Compare sent with received messages: counts, losses, strangers, duplicates, fingerprints.

    Messages are folded to one row per distinct text before anything else is compared, with
    map-side combining, so a message delivered very often is only a counter.
    """
    sides = expected.select(F.col(message).alias("m"), F.lit(1).alias("e"), F.lit(0).alias("c")).unionByName(
        consumed.select(F.col(message).alias("m"), F.lit(0).alias("e"), F.lit(1).alias("c"))
    )
    folded = sides.groupBy("m").agg(F.sum("e").alias("e"), F.sum("c").alias("c"))
    term = F.conv(F.substring(F.sha2(F.coalesce("m", F.lit("\\N")), 256), 1, 15), 16, 10).cast("decimal(19,0)")

    def fingerprint(n: str) -> Column:
        return F.coalesce(F.sum(term * F.col(n).cast("decimal(18,0)")), F.lit(0)).cast("decimal(38,0)").cast("string")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    out = folded.agg(
        total(F.col("e")).alias("expected_count"),
        total(F.col("c")).alias("consumed_count"),
        F.count_if(F.col("c") > 0).alias("unique_consumed_count"),
        total(F.greatest(F.col("e") - F.col("c"), F.lit(0))).alias("missing_count"),
        F.count_if((F.col("e") == 0) & (F.col("c") > 0)).alias("unexpected_count"),
        total(F.greatest(F.col("c") - 1, F.lit(0))).alias("duplicated_count"),
        fingerprint("e").alias("expected_checksum"),
        fingerprint("c").alias("consumed_checksum"),
    )
    return out.withColumn("intact", F.col("expected_checksum") == F.col("consumed_checksum"))


def write_integrity(written: DataFrame, reread: DataFrame, columns: Sequence[Column | str] | None = None) -> DataFrame:
    """Rows and fingerprint before a write against those of the re-read result, as one row."""
    before = table_checksum(written, columns).select(F.struct("n_rows", "checksum").alias("s")).scalar()
    return (
        table_checksum(reread, columns)
        .withColumn("_b", before)
        .select(
            F.col("_b.n_rows").alias("rows_written"),
            F.col("n_rows").alias("rows_reread"),
            ((F.col("_b.n_rows") == F.col("n_rows")) & (F.col("_b.checksum") == F.col("checksum"))).alias("intact"),
        )
    )
