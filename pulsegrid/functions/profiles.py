"""Array expressions over a fixed-length daily profile."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fill_profile(values: Column) -> Column:
    """Straight-line fill between the known slots of an array; the ends take the nearest value.

    The array is one row's own profile (24 slots), so nothing is shuffled or sorted for it.
    """
    slots = F.sequence(F.lit(0), F.size(values) - 1)
    known = F.filter(slots, lambda i: F.get(values, i).isNotNull())

    def at(i: Column) -> Column:
        before = F.array_max(F.filter(known, lambda k: k <= i))
        after = F.array_min(F.filter(known, lambda k: k >= i))
        low, high = F.get(values, before), F.get(values, after)
        between = low + (high - low) * (i - before) / (after - before)
        return (
            F.when(before.isNull(), high)
            .when(after.isNull() | (before == after), low)
            .otherwise(between)
        )

    return F.transform(slots, at)
