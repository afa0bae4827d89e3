"""Row-level expressions.  All stay inside the JVM; none is a Python UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def percent_of(part: Column | str, whole: Column | str, digits: int | None = 1) -> Column:
    """``part / whole`` in percent; NULL where the whole is zero or either side is missing."""
    rate = F.try_divide(_c(part), _c(whole)) * 100
    return rate if digits is None else F.round(rate, digits)


def cap_at(value: Column | str, limit: float = 100.0, missing_is_limit: bool = False) -> Column:
    """Upper bound.  ``least`` skips NULL, so an unknown value would turn into the limit;
    that happens only when ``missing_is_limit`` asks for it."""
    value = _c(value)
    capped = F.least(value, F.lit(limit))
    return capped if missing_is_limit else F.when(value.isNotNull(), capped)


def clip_low(value: Column | str, floor: float = 0.0) -> Column:
    """Lower bound that keeps NULL."""
    value = _c(value)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def share_of(part: Column | str, whole: Column | str) -> Column:
    """Fraction where the whole is positive, else NULL."""
    whole = _c(whole)
    return F.when(whole > 0, _c(part) / whole)


def to_whole(value: Column | str) -> Column:
    """Nearest whole number, ties to even, as BIGINT."""
    return F.bround(_c(value)).cast("bigint")


def number_or_null(value: Column | str) -> Column:
    """DOUBLE from any type; unreadable text and NaN become NULL."""
    return F.nanvl(_c(value).try_cast("double"), F.lit(None).cast("double"))


def blank(value: Column | str) -> Column:
    """True for NULL, the empty string and strings made of white space only."""
    value = _c(value)
    return value.isNull() | (F.regexp_replace(value.cast("string"), r"\s+", "") == "")


def row_mean(*values: Column | str) -> Column:
    """Mean over the columns of one row, leaving out the missing ones."""
    columns = [_c(v) for v in values]
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.try_divide(total, present)


def band(rate: Column | str, low: float = 5.0, high: float = 95.0) -> Column:
    """Tension band of an occupancy rate in percent."""
    rate = _c(rate)
    return (
        F.when(rate.isNull(), F.lit("unknown"))
        .when(rate <= low, F.lit("near_empty"))
        .when(rate >= high, F.lit("near_full"))
        .otherwise(F.lit("balanced"))
    )


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Time-of-day and day-of-week features; Monday is day 0."""
    ts = _c(ts)
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    angle = minute_of_day * F.lit(2 * math.pi / 1440)
    weekday = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "dow": weekday,
        "weekend": (weekday >= 5).cast("int"),
        "sin_t": F.sin(angle),
        "cos_t": F.cos(angle),
    }
