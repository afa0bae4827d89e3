"""Footers of Parquet files, read by tasks: column types and value ranges."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType

_MAGIC = b"PAR1"
FOOTER = "path string, bytes long, n_rows long, error string, columns array<struct<name: string, type: string>>"


def _tails(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes and footer of every Parquet file below ``root``.

    One file at a time is opened where Spark runs the task, through Spark's own file systems; only the footer
    goes on from there.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = files.where(F.col("path").rlike(r"(?i)\.parquet$"))
    size = F.hex(F.substr("content", F.length("content") - 7, F.lit(4)))        # little-endian
    size = F.conv(F.concat(*[F.substring(size, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")
    size = F.least(size, F.length("content").cast("long") - 8).cast("int")
    ends = F.length("content") >= 12
    return files.select("path", F.col("length").alias("bytes"), F.when(
        ends, F.substr("content", F.greatest(F.length("content") - size - 7, F.lit(1)), size + 8)).alias("tail"))


def _metadata(tail: bytes | None) -> pq.FileMetaData:
    if not tail or tail[-4:] != _MAGIC or struct.unpack("<I", tail[-8:-4])[0] + 8 != len(tail):
        raise ValueError("no footer")
    return pq.read_metadata(pa.BufferReader(_MAGIC + tail))


def _type_name(kind: pa.DataType) -> str:
    """The Spark type a Parquet column is read as; what has no plain type reads as text."""
    if pa.types.is_integer(kind):
        return "int" if kind.bit_width < 32 or kind == pa.int32() else "bigint"
    if pa.types.is_floating(kind):
        return "double" if kind == pa.float64() else "float"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    return {pa.bool_(): "boolean", pa.date32(): "date", pa.binary(): "binary"}.get(kind, "string")


def file_types(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes, n_rows, columns (name and type) of every Parquet file below ``root``; ``error`` where a file has none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                out = {"path": row["path"], "bytes": row["bytes"], "n_rows": None, "error": None, "columns": None}
                try:
                    meta = _metadata(row["tail"])
                    schema = meta.schema.to_arrow_schema()
                    out |= {"n_rows": meta.num_rows, "columns": [{"name": f.name, "type": _type_name(f.type)} for f in schema]}
                except (ValueError, OSError) as problem:          # pyarrow's errors are of these kinds
                    out["error"] = f"{type(problem).__name__}: {problem}"[:200]
                rows.append(out)
            yield pa.RecordBatch.from_pylist(rows, schema=_TYPES)

    return _tails(spark, root).mapInArrow(read, FOOTER)


_TYPES = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("n_rows", pa.int64()), ("error", pa.string()),
                    ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])))])


def file_ranges(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """path, bytes, n_rows and per column its least and greatest value in the file (``min_c``, ``max_c``).

    From the footers' statistics; both are NULL where a file has none for a column, so a reader must open it.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kinds: dict[str, DataType] = {c: spark.read.parquet(root).schema[c].dataType for c in columns}
    arrow = {c: to_arrow_type(k) for c, k in kinds.items()}
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("n_rows", pa.int64()),
                        *[(f"{end}_{c}", arrow[c]) for c in columns for end in ("min", "max")]])
    ddl = ", ".join(["path string", "bytes long", "n_rows long",
                     *[f"`{end}_{c}` {kinds[c].simpleString()}" for c in columns for end in ("min", "max")]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                meta = _metadata(row["tail"])
                out = {"path": row["path"], "bytes": row["bytes"], "n_rows": meta.num_rows}
                for c in columns:
                    out[f"min_{c}"], out[f"max_{c}"] = _range(meta, c)
                rows.append(out)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _tails(spark, root).mapInArrow(read, ddl)


def _range(meta: pq.FileMetaData, column: str) -> tuple:
    """Least and greatest value over all row groups; nothing unless each group that holds values states them."""
    at = meta.schema.names.index(column)
    low, high = [], []
    for group in range(meta.num_row_groups):
        chunk = meta.row_group(group).column(at)
        stats = chunk.statistics
        if stats is not None and stats.has_null_count and stats.null_count == chunk.num_values:
            continue
        if stats is None or not stats.has_min_max:
            return None, None
        low.append(stats.min)
        high.append(stats.max)
    return (min(low), max(high)) if low else (None, None)
