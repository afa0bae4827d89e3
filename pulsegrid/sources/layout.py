"""Tables sorted by a key, with an index that says which files a look-up needs."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .footers import file_ranges


class Selected(NamedTuple):
    rows: DataFrame
    files_opened: int
    files: int


def write_sorted(df: DataFrame, root: str, keys: Sequence[str], files: int) -> DataFrame:
    """Write ``df`` in about ``files`` files that follow one another by ``keys``; returns and stores their index.

    Ranges come from a sample of the keys, so files are about equally large; rows that share all keys cannot be
    told apart and stay together, so add a further key (a time) where one value is frequent.  The index is one
    row per file, read from the footers, below ``<root>-index``.
    """
    ordered = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    # footers hold no ranges for the older timestamp format
    spark, name = df.sparkSession, "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        ordered.write.mode("overwrite").parquet(root)
    finally:
        spark.conf.set(name, before)
    index = file_ranges(df.sparkSession, root, keys)
    index.write.mode("overwrite").parquet(_index(root))
    return read_index(df.sparkSession, root)


def _index(root: str) -> str:
    return f"{root.rstrip('/')}-index"


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(_index(root))


def overlaps(column: str, low=None, high=None) -> Column:
    """Whether a file may hold values from ``low`` to ``high`` (both included; None: no bound)."""
    least, most = F.col(f"min_{column}"), F.col(f"max_{column}")
    may = F.lit(True)
    if low is not None:
        may = may & (most.isNull() | (most >= F.lit(low)))
    if high is not None:
        may = may & (least.isNull() | (least <= F.lit(high)))
    return may


def read_range(spark: SparkSession, root: str, **bounds: tuple) -> Selected:
    """Rows of a table written by :func:`write_sorted` whose columns lie within ``bounds`` (column to (low, high)).

    The index decides which files are opened; within them the filters reach the scan.
    """
    index = read_index(spark, root)
    schema = spark.read.parquet(root).schema
    may, exact = F.lit(True), F.lit(True)
    for column, (low, high) in bounds.items():
        may = may & overlaps(column, low, high)
        exact = exact & (F.lit(True) if low is None else F.col(column) >= F.lit(low))
        exact = exact & (F.lit(True) if high is None else F.col(column) <= F.lit(high))
    paths = [row["path"] for row in index.where(may).select("path").collect()]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return Selected(rows.where(exact), len(paths), index.count())
