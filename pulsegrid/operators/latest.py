"""One row per key: newest state, first seen, or the single newest row of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

_RANK = "_pg_rank"


def _ranked_first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # row_number() = 1 right above the window lets Spark plan WindowGroupLimit on both sides
    # of the exchange: every map task ships at most one row per key, however hot the key is.
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Newest row of every key.  ``newest_by`` lists the time column first and then every
    tie-breaker, so that equal timestamps give the same answer on every run."""
    return _ranked_first(df, keys, [F.col(c).desc_nulls_last() for c in newest_by])


def first_per_key(df: DataFrame, keys: Sequence[str], oldest_by: Sequence[str]) -> DataFrame:
    """Batch de-duplication that keeps the first row under a total order."""
    return _ranked_first(df, keys, [F.col(c).asc_nulls_last() for c in oldest_by])


def newest_row(df: DataFrame, newest_by: Sequence[str]) -> DataFrame:
    """The newest row of a whole table (one row, or none for an empty table)."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in newest_by]).limit(1)


def newest_as_struct(df: DataFrame, newest_by: Sequence[str], fields: dict[str, str]) -> Column:
    """The newest row as a scalar struct column (``fields`` maps new name -> column).

    A scalar subquery always yields exactly one value, NULL for an empty table, so attaching
    it can neither multiply nor drop rows and needs no cross join.
    """
    payload = F.struct(*[F.col(source).alias(name) for name, source in fields.items()])
    order = F.struct(*newest_by)
    return df.where(F.col(newest_by[0]).isNotNull()).agg(F.max_by(payload, order).alias("newest")).scalar()
