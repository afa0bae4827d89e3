"""Helpers shared by the corpus operators: words, stored intermediate tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.session import scratch_path

# words are runs of anything but the six ASCII blanks; bytes.split() cuts at exactly these
WORD = r"[^\x20\x09-\x0D]+"
TEXTS = 500  # texts that a worker holds as Python objects at a time; Arrow hands over up to 10,000 rows


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lowered (bytes.lower leaves all other letters alone)."""
    return text.lower().split()


def all_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (UTF-8 bytes, none NULL) in a row, and where each text's begin; the number of all at the end."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    found, starts = cut.flatten().view(pa.binary()), cut.offsets.to_numpy()
    full = pc.greater(pc.binary_length(found), 0)  # blanks at an end of a text leave an empty string there
    return found.filter(full), np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[starts]


def word_count(column: str | Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(WORD)).cast("long")


class Stored:
    """Intermediate tables below the shared folder: they cut lineage and outlive lost executors.

    Tables are removed by ``drop`` once nothing reads them; the last one a result reads stays.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_path(spark, label)
        self.names: list[str] = []

    def save(self, frame: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.root}/{name}"
        self.names.append(name)
        frame.write.options(**options).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop_all(self) -> None:
        self.drop(*self.names)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.names = [name for name in self.names if name not in names]


def binary_text(column: str | Column = "text") -> Column:
    """The text as UTF-8 bytes, NULL as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int | None = None):
    """A ``mapInArrow`` function from one that turns a batch into a batch (or nothing); it gets at most ``rows`` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows or batch.num_rows or 1):
                if (out := work(batch.slice(at, rows))) is not None:
                    yield out
            batch = out = None  # else held while the next one is read
        pa.default_memory_pool().release_unused()  # a worker lives on

    return run
