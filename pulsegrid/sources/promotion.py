"""Parquet files whose column types differ, as one table of the types that hold them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .footers import file_types

# each type with those it can become without another loss than that of the target's precision
_WIDER = {"int": ("int", "bigint", "double", "string"), "bigint": ("bigint", "double", "string"),
          "float": ("float", "double", "string"), "double": ("double", "string"), "date": ("date", "timestamp_ntz", "string"),
          "timestamp_ntz": ("timestamp_ntz", "string"), "timestamp": ("timestamp", "string"), "boolean": ("boolean", "string")}


def wider(a: str, b: str) -> str:
    """The least type that both can become; text if no other."""
    if a == b:
        return a
    if a.startswith("decimal") or b.startswith("decimal"):
        a, b = ("double" if t.startswith("decimal") else t for t in (a, b))
    others = _WIDER.get(b, ("string",))
    return next((t for t in _WIDER.get(a, ("string",)) if t in others), "string")


def promoted_schema(types: DataFrame) -> dict[str, str]:
    """Column names, in the order of their first file, and the type that holds all files' values.

    ``types`` comes from :func:`file_types`.  Only the distinct (column, type) pairs leave the executors: as
    many as the table has columns, times the few types a column occurs in.
    """
    pairs = (types.select("path", F.posexplode("columns").alias("place", "column"))
             .groupBy("column.name", "column.type").agg(F.min(F.struct("path", "place")).alias("first")).collect())
    out: dict[str, str] = {}
    for row in sorted(pairs, key=lambda r: (r["first"]["place"], r["first"]["path"], r["name"])):
        out[row["name"]] = wider(out[row["name"]], row["type"]) if row["name"] in out else row["type"]
    return out


def _cast(name: str, own: dict[str, str], to: str) -> Column:
    if name not in own:
        return F.lit(None).cast(to).alias(name)
    return F.col(f"`{name}`").cast(to).alias(name)


def read_promoted(spark: SparkSession, root: str, schema: dict[str, str] | None = None) -> DataFrame:
    """All readable Parquet files below ``root`` as one table; missing columns are NULL.

    Tasks read the footers, files are grouped by their own schema, and each group is scanned once with that
    schema and cast to the common one, so column pruning and filters still reach every scan.  ``schema`` (name
    to type) fixes the result's columns instead.  Files without a readable footer are left out and listed by
    :func:`unreadable`; with none readable this fails.
    """
    types = file_types(spark, root)
    schema = schema or promoted_schema(types)
    ddl = F.array_join(F.transform("columns", lambda c: F.concat(F.lit("`"), c["name"], F.lit("` "), c["type"])), ", ")
    groups = types.where("error IS NULL").select(ddl.alias("ddl"), "path").groupBy("ddl").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    parts = []
    for group in groups.orderBy("ddl").toLocalIterator():
        part = spark.read.schema(group["ddl"]).parquet(*group["paths"])
        own = dict(part.dtypes)
        parts.append(part.select(*[_cast(name, own, to) for name, to in schema.items()]))
    if not parts:
        raise FileNotFoundError(f"no readable Parquet file below {root}")
    return reduce(DataFrame.unionByName, parts)


def unreadable(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes and error of the files that :func:`read_promoted` leaves out; files of no bytes are not listed."""
    return file_types(spark, root).where("error IS NOT NULL").select("path", "bytes", "error")
