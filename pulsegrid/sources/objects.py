"""Backup and restore by object: content hashes, incremental copies, lost objects and bytes.

A store holds ``objects`` (files named by the SHA-256 of their bytes, so equal contents are kept once and a repeated
or interrupted backup changes nothing) and ``manifests`` (a Parquet table per version).  Spark lists the objects and
shares them out; a task streams one object at a time in pieces of a few MB, so objects of any size are hashed and
copied without being held, and no byte passes through the driver.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.operators.audit import manifest_diff

from .files import inventory

MANIFEST = "path string, bytes long, modified timestamp, sha256 string, copied boolean"
_DONE = "path string, sha256 string, copied boolean"
_DONE_ARROW = pa.schema([("path", pa.string()), ("sha256", pa.string()), ("copied", pa.bool_())])
_PIECE = 8 * 1024 * 1024


class DamagedObject(RuntimeError):
    """A stored object's bytes do not have the hash it is named by."""


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Spark path: a plain path, ``file:``, ``hdfs://``, ``s3a://``, ``gs://``."""
    found = re.match(r"^(?!file:)([a-z0-9]+)://([^/]*)/*(.*)$", path, re.DOTALL)
    if not found:
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    scheme, host, name = found.groups()
    files, base = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{host}/")
    return files, posixpath.join(base, name)


def _stream(source: str, target: str | None) -> str:
    """SHA-256 of an object, which is copied on the way if there is a target."""
    files, name = _place(source)
    digest = hashlib.sha256()
    out = None
    if target is not None:
        target_files, target_name = _place(target)
        target_files.create_dir(posixpath.dirname(target_name))
        out = target_files.open_output_stream(target_name, compression=None)
    try:
        with files.open_input_stream(name, compression=None) as stream:
            while piece := stream.read(_PIECE):
                digest.update(piece)
                if out is not None:
                    out.write(piece)
    finally:
        if out is not None:
            out.close()
    return digest.hexdigest()


def _move(source: str, target: str) -> None:
    files, name = _place(source)
    target_name = _place(target)[1]
    files.create_dir(posixpath.dirname(target_name))
    files.move(name, target_name)


def _stored(store: str, sha256: str) -> str:
    return f"{store}/objects/{sha256[:2]}/{sha256}"


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """Objects below a root by their path from it, with bytes and modification time; contents are not read.

    Names that start with ``_`` or ``.`` and objects without a byte are left out, as they are of any scan.
    """
    inside = F.regexp_replace(F.regexp_replace("path", "^file:/*", "/"), "^" + re.escape(re.sub("^file:/*", "/", root)) + "/*", "")
    return inventory(spark, {"": root}).select(inside.alias("path"), "bytes", F.col("modificationTime").alias("modified"))


def _each(objects: DataFrame, columns: list[str], work) -> DataFrame:
    """``work`` on every object, shared out evenly by number over the session's tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([work(row)], schema=_DONE_ARROW)

    return objects.select(*columns).repartition("path").mapInArrow(run, _DONE)


def object_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes, modified, sha256 of every object below ``root``; every object is read."""
    root = root.rstrip("/")
    listing = _listing(spark, root)
    hashes = _each(listing, ["path"], lambda row: {"path": row["path"], "sha256": _stream(f"{root}/{row['path']}", None), "copied": False})
    return listing.join(hashes.drop("copied"), "path")


def read_manifest(spark: SparkSession, store: str, version: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{store.rstrip('/')}/manifests/{version}")


def backup_objects(spark: SparkSession, root: str, store: str, version: str, after: str | None = None) -> DataFrame:
    """Back up all objects below ``root`` as ``version``; returns its manifest (``copied``: written by this run).

    With ``after``, an earlier version, only objects that are new or whose bytes or modification time differ are
    read.  An object whose bytes the store already holds is not written again.  Stop writers first, or copy a
    published snapshot: an object that changes while it is read is stored as it was read.
    """
    root, store = root.rstrip("/"), store.rstrip("/")
    listing = _listing(spark, root)
    known = listing.limit(0).withColumn("sha256", F.lit(None).cast("string"))
    if after is not None:
        known = listing.join(read_manifest(spark, store, after).drop("copied"), ["path", "bytes", "modified"])

    def take(row: dict) -> dict:
        part = f"{store}/objects/.{uuid.uuid4().hex}"
        sha256 = _stream(f"{root}/{row['path']}", part)
        target = _stored(store, sha256)
        files, name = _place(target)
        there = files.get_file_info(name).type != fs.FileType.NotFound
        if there:
            files.delete_file(_place(part)[1])
        else:
            _move(part, target)
        return {"path": row["path"], "sha256": sha256, "copied": not there}

    fresh = listing.join(known.select("path"), "path", "left_anti")
    taken = listing.join(_each(fresh, ["path"], take), "path")
    whole = taken.select("path", "bytes", "modified", "sha256", "copied").unionByName(known.withColumn("copied", F.lit(False)))
    whole.write.mode("overwrite").parquet(f"{store}/manifests/{version}")
    return read_manifest(spark, store, version)


def compare_objects(spark: SparkSession, root: str, store: str, version: str) -> DataFrame:
    """State of every object (same, changed, missing, unexpected) against a backup, with bytes on both sides.

    ``operators.recovery_point`` folds it to objects and bytes lost.
    """
    kept = read_manifest(spark, store, version)
    return manifest_diff(kept, object_manifest(spark, root), checksum="sha256", size="bytes")


def restore_objects(spark: SparkSession, root: str, store: str, version: str) -> DataFrame:
    """Put back what is missing or changed below ``root``; returns the path, sha256 and bytes of what was.

    Each object is written beside its place, checked against its hash and then moved, so that readers see it whole;
    a damaged stored object fails the restore.  Objects that are not in the backup stay.
    """
    root, store = root.rstrip("/"), store.rstrip("/")
    lost = compare_objects(spark, root, store, version).where(F.col("state").isin("missing", "changed"))
    wanted = read_manifest(spark, store, version).join(lost.select("path"), "path", "left_semi").select("path", "sha256", "bytes")

    def put(row: dict) -> dict:
        target = f"{root}/{row['path']}"
        part = f"{posixpath.dirname(target)}/.{uuid.uuid4().hex}"
        found = _stream(_stored(store, row["sha256"]), part)
        if found != row["sha256"]:
            files, name = _place(part)
            files.delete_file(name)
            raise DamagedObject(f"{row['path']}: stored bytes have hash {found}, not {row['sha256']}")
        _move(part, target)
        return {"path": row["path"], "sha256": found, "copied": True}

    log = f"{store}/restores/{uuid.uuid4().hex}"
    _each(wanted, ["path", "sha256"], put).drop("copied").join(wanted.select("path", "bytes"), "path").write.parquet(log)
    return spark.read.parquet(log)
