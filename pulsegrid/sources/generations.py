"""Compaction of a growing folder of Parquet files, beside its writer and its readers.

Small files are packed into larger ones, and a manifest says which files those replace.  A generation is one
entry of the manifest: the files it replaced and the files it added, put in place by one rename.  The live files
of a table are

    (files listed below the table + files added by generations) - files replaced by generations

so files that a writer appends are live at once, and the swap of a generation happens for a reader when it reads
the manifest: rows are never seen twice and never missed.  Replaced files stay until :func:`drop_replaced`, so a
reader that began before a swap can end.

Only files below ``small_bytes`` are rewritten, and only where two or more share a new file.  One compaction
runs at a time; of two that end together the second fails and leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import inventory

MB = 1024 * 1024
_ENTRY = "generation long, action string, path string, bytes long"
_GROUP = 20_000  # most files of a folder that one task packs


def _manifest(root: str) -> str:
    return f"{root.rstrip('/')}-generations"


def _added(root: str) -> str:
    return f"{root.rstrip('/')}-compacted"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """generation, action (``replaced`` or ``added``), path and bytes of all generations."""
    try:
        return spark.read.schema(_ENTRY).option("recursiveFileLookup", "true").json(_manifest(root))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def _key_of(path: str) -> str:
    scheme, _, rest = path.partition(":")
    return unquote(f"{scheme}:/{rest.lstrip('/')}" if rest else path)


def _plain(path: str) -> F.Column:
    return F.regexp_replace(F.col(path), "^([a-z0-9]+):/+", "$1:/")       # one spelling of the root


def live_files(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes and place (``table`` or ``compacted``) of the files that hold the table's rows now.

    Files that a stream's log names but that are gone are left out: :func:`read_live` fails if one was not replaced.
    """
    listed = inventory(spark, {"table": root}, gone_too=True).where(F.col("path").rlike(r"(?i)\.parquet$"))
    entries = manifest(spark, root)
    added = entries.where("action = 'added'").select(F.lit("compacted").alias("place"), "path", "bytes")
    gone = entries.where("action = 'replaced'").select(_plain("path").alias("key")).distinct()
    files = listed.select(F.col("zone").alias("place"), "path", "bytes").unionByName(added).withColumn("key", _plain("path"))
    return files.join(gone, "key", "left_anti").select("path", "bytes", "place")


def read_live(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """The table's rows as of now.  ``schema`` spares the look into a file."""
    parts = []
    named = [_key_of(p) for p in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).inputFiles()]
    files = [(r["place"], r["path"]) for r in live_files(spark, root).select("place", "path").collect()]     # one state for both
    there = {_key_of(path) for _, path in files} | {
        _key_of(r["path"]) for r in manifest(spark, root).where("action = 'replaced'").select("path").collect()}
    lost = [p for p in named if p.lower().endswith(".parquet") and p not in there]
    if lost:
        raise FileNotFoundError(f"{len(lost)} files of {root} are gone, the first is {lost[0]}")
    for place, base in (("table", root), ("compacted", _added(root))):
        paths = [path for where, path in files if where == place]
        if paths:
            reader = spark.read.option("basePath", base)
            part = (reader.schema(schema) if schema else reader).parquet(*paths)
            parts.append(part.drop("_generation", "_bin"))
    if not parts:
        raise FileNotFoundError(f"no live file of {root}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def first_fit(sizes: list[int], room: int) -> list[int]:
    """Bin of each size, largest first into the first bin with room; a tree over the bins' room finds it."""
    width = 1
    while width < max(len(sizes), 1):
        width *= 2
    free = [room] * (2 * width)
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = 1
        while at < width:
            at = 2 * at if free[2 * at] >= sizes[i] else 2 * at + 1
        out[i] = at - width
        free[at] -= sizes[i]
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
    return out


def packing_plan(files: DataFrame, target_bytes: int, small_bytes: int) -> DataFrame:
    """path, bytes, folder, bin of the small files that share a new file with another one.

    Files are packed per folder; a folder with very many is packed in parts by a hash of the path.
    """
    small = (files.where(F.col("bytes") < small_bytes)
             .withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1)))
    counts = small.groupBy("folder").agg(F.ceil(F.count("*") / _GROUP).alias("parts"))
    small = small.join(counts, "folder").withColumn("part", F.pmod(F.xxhash64("path"), F.col("parts")))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "path"], ascending=[False, True])
        bins = pd.Series(first_fit([min(b, target_bytes) for b in group["bytes"]], target_bytes), index=group.index)
        shared = bins.map(bins.value_counts()) > 1
        out = group[["path", "bytes", "folder"]].assign(bin=bins.map(lambda b: f"{group['part'].iloc[0]}-{b}"))
        return out[shared]

    return small.groupBy("folder", "part").applyInPandas(pack, "path string, bytes long, folder string, bin string")


@contextmanager
def _unsorted(spark: SparkSession, files: int = 256) -> Iterator[None]:
    """Writes inside keep a file open for each folder a task writes to, up to ``files``, rather than sort the task's rows first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Compaction:
    """One generation in the making: ``rewrite`` makes the new files, ``publish`` swaps them in."""

    def __init__(self, spark: SparkSession, root: str, *, target_bytes: int = 512 * MB, small_bytes: int | None = None):
        self.spark, self.root, self.target = spark, root.rstrip("/"), target_bytes
        self.small = target_bytes // 2 if small_bytes is None else small_bytes
        self.scratch = f"{_manifest(self.root)}-plan-{uuid.uuid4().hex}"
        newest = manifest(spark, root).agg(F.max("generation")).first()[0]
        self.generation = 1 + (newest or 0)
        self.label = f"{self.generation}-{uuid.uuid4().hex[:8]}"      # an attempt that was given up leaves files of another name

    def rewrite(self) -> int:
        """Write the new files; returns how many files they replace (0: nothing to do)."""
        spark = self.spark
        packing_plan(live_files(spark, self.root), self.target, self.small).write.parquet(f"{self.scratch}/plan")
        plan = spark.read.parquet(f"{self.scratch}/plan")
        names = [r["path"] for r in plan.select("path").collect()]
        if not names:
            return 0
        bins = plan.select(_plain("path").alias("_key"), F.col("folder").alias("_folder"), F.col("bin").alias("_bin"))
        for place, base in (("table", self.root), ("compacted", _added(self.root))):
            paths = [p for p in names if self._below(p, base)]
            if not paths:
                continue
            rows = spark.read.option("basePath", base).parquet(*paths)
            partitions = [f for f in rows.columns if f not in ("_generation", "_bin") and any(f"/{f}=" in p for p in paths[:1])]
            rows = rows.drop("_generation", "_bin").withColumn("_key", _plain("_metadata.file_path"))
            packed = rows.join(bins, "_key").drop("_key").withColumn("_generation", F.lit(f"{self.label}-{place}"))
            # a bin's rows meet in one task and one file
            count = plan.select("folder", "bin").distinct().count()
            with _unsorted(spark):
                (packed.repartition(min(count, 10_000), "_folder", "_bin").drop("_folder")
                 .write.partitionBy("_generation", *partitions, "_bin").mode("append").parquet(_added(self.root)))
        return len(names)

    @staticmethod
    def _below(path: str, base: str) -> bool:
        return f"{base.split(':', 1)[-1].lstrip('/')}/" in path

    def publish(self) -> DataFrame:
        """Put the generation in place; returns files and bytes replaced and added."""
        spark = self.spark
        plan = spark.read.parquet(f"{self.scratch}/plan")
        replaced = plan.select(F.lit("replaced").alias("action"), "path", "bytes")
        made = (inventory(spark, {"": _added(self.root)})
                .where(F.col("path").rlike(rf"/_generation={self.label}-(table|compacted)/.*\.parquet$"))
                .select(F.lit("added").alias("action"), "path", "bytes"))
        entry = replaced.unionByName(made).select(F.lit(self.generation).cast("long").alias("generation"), "action", "path", "bytes")
        entry.coalesce(1).write.json(f"{self.scratch}/entry")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        source, target = hadoop(f"{self.scratch}/entry"), hadoop(f"{_manifest(self.root)}/generation-{self.generation:012d}")
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(target.getParent())
        if files.exists(target) or not files.rename(source, target):
            raise RuntimeError(f"generation {self.generation} of {self.root} was made by someone else")
        files.delete(hadoop(self.scratch), True)
        return (manifest(spark, self.root).where(F.col("generation") == self.generation)
                .groupBy("generation").agg(*[m for action in ("replaced", "added") for m in (
                    F.count_if(F.col("action") == action).alias(f"files_{action}"),
                    F.coalesce(F.sum(F.when(F.col("action") == action, F.col("bytes"))), F.lit(0)).alias(f"bytes_{action}"))]))


def compact_live(spark: SparkSession, root: str, **options) -> DataFrame | None:
    """One :class:`Compaction` from plan to swap; None where nothing is small enough."""
    job = Compaction(spark, root, **options)
    return job.publish() if job.rewrite() else None


def drop_replaced(spark: SparkSession, root: str, upto: int) -> int:
    """Delete files that generations up to ``upto`` replaced, once no reader is left that began before them.

    The manifest keeps naming them, so a listing that still shows one (a stream's own log) does no harm.
    """
    hadoop, gone = spark._jvm.org.apache.hadoop.fs.Path, 0
    old = manifest(spark, root).where((F.col("action") == "replaced") & (F.col("generation") <= upto)).select("path")
    for path in _paths(old):
        target = hadoop(path)
        gone += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False))
    return gone


def _paths(frame: DataFrame) -> Iterator[str]:
    return (row["path"] for row in frame.toLocalIterator())
