"""Aggregate expressions used by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Stand-ins that keep "missing" apart from "empty" and fields apart from each other.
_FIELD_SEPARATOR = "\x1f"
_MISSING = "\\N"


def mean_of(value: Column | str) -> Column:
    """Mean as sum over count.  With DECIMAL input the sum is exact, so the result does not
    depend on the order in which partitions are merged."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def regression_scores(actual: Column, predicted: Column) -> dict[str, Column]:
    """MAE, RMSE and R2 in one pass.  The total sum of squares comes from ``var_pop``, whose
    merge step is stable, rather than from a difference of two large sums."""
    error = actual - predicted
    squared = F.sum(error * error).cast("double")
    spread = F.var_pop(actual) * F.count(actual)
    return {
        "mae": mean_of(F.abs(error)),
        "rmse": F.sqrt(F.try_divide(squared, F.count(error))),
        "r2": F.lit(1.0) - F.try_divide(squared, spread),
    }


def row_digest(columns: Iterable[Column | str]) -> Column:
    """SHA-256 of one row in a fixed column order, as hex text."""
    fields = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(_MISSING)) for c in columns]
    return F.sha2(F.concat_ws(_FIELD_SEPARATOR, *fields), 256)


def digest_sum(digest: Column | str) -> Column:
    """Order-free fingerprint of many rows: the first 60 bits of each digest, added up exactly.

    Returned as text because the sum needs more than 64 bits.
    """
    digest = F.col(digest) if isinstance(digest, str) else digest
    term = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(19,0)")
    return F.coalesce(F.sum(term), F.lit(0)).cast("decimal(38,0)").cast("string")
