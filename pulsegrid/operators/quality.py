"""Row rules, table expectations, routing and the run report of the quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from pulsegrid.functions import blank, number_or_null

ERRORS = "_errors"


class ContractCheck(NamedTuple):
    """Unpacks like ``ok, missing, wrong_types``."""

    ok: bool
    missing: list[str]
    wrong_types: list[tuple[str, str, str]]


def check_contract(df: DataFrame | StructType, required: dict[str, DataType]) -> ContractCheck:
    """Compare a schema with the columns and types a consumer needs.

    Extra columns and nullability are not part of the contract; no data is read.
    """
    schema = df if isinstance(df, StructType) else df.schema
    actual = {field.name: field.dataType.simpleString() for field in schema}
    missing = [name for name in required if name not in actual]
    wrong = [
        (name, wanted.simpleString(), actual[name])
        for name, wanted in required.items()
        if name in actual and actual[name] != wanted.simpleString()
    ]
    return ContractCheck(not missing and not wrong, missing, wrong)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Return ``df`` or fail with the absent columns, in the order they were asked for."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")
    return df


def keep_in_range(df: DataFrame, column: str, low: float = 1, high: float = 100) -> DataFrame:
    """Rows whose value lies in the inclusive range; NULL and NaN rows go."""
    return df.where(F.col(column).between(low, high))


# ---- row rules -----------------------------------------------------------------------------


@dataclass(frozen=True)
class NotBlank:
    column: str
    reason: str

    def broken(self) -> Column:
        return blank(self.column)


@dataclass(frozen=True)
class Within:
    """A missing or unreadable value breaks the rule as well."""

    column: str
    low: float
    high: float
    reason: str

    def broken(self) -> Column:
        return ~F.coalesce(number_or_null(self.column).between(self.low, self.high), F.lit(False))


@dataclass(frozen=True)
class NotAbove:
    """``column`` must not exceed ``limit``; judged only where both are readable."""

    column: str
    limit: str
    reason: str

    def broken(self) -> Column:
        return F.coalesce(number_or_null(self.column) > number_or_null(self.limit), F.lit(False))


Rule = NotBlank | Within | NotAbove


def with_errors(df: DataFrame, rules: Sequence[Rule], name: str = ERRORS) -> DataFrame:
    """Add the reasons of all broken rules, in rule order, as an array."""
    found = [F.when(rule.broken(), F.lit(rule.reason)) for rule in rules]
    return df.withColumn(name, F.array_compact(F.array(*found)))


def accepted(checked: DataFrame, errors: str = ERRORS) -> DataFrame:
    return checked.where(F.size(errors) == 0).drop(errors)


def quarantined(checked: DataFrame, errors: str = ERRORS, joined: str = "_quality_errors") -> DataFrame:
    """Rejected rows with all their columns and the reasons joined by ``|``."""
    return checked.where(F.size(errors) > 0).withColumn(joined, F.concat_ws("|", errors)).drop(errors)


# ---- table expectations --------------------------------------------------------------------


@dataclass(frozen=True)
class RowCountBetween:
    low: int
    high: int

    name = "row_count_between"
    column = "table"

    def unexpected(self) -> Column:
        return F.when(F.count(F.lit(1)).between(self.low, self.high), 0).otherwise(1).cast("bigint")


@dataclass(frozen=True)
class NotNull:
    column: str

    name = "not_null"

    def unexpected(self) -> Column:
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class Between:
    """Missing values are left out here, unlike in the row rule :class:`Within`."""

    column: str
    low: float
    high: float

    name = "between"

    def unexpected(self) -> Column:
        value = number_or_null(self.column)
        return F.count_if(value.isNotNull() & ~value.between(self.low, self.high))


Expectation = RowCountBetween | NotNull | Between


def gate_measures(rules: Sequence[Rule], expectations: Sequence[Expectation], errors: str = ERRORS) -> list[Column]:
    """Every number of the run report as one list of aggregates over checked rows, so that
    counts, reasons and expectations cost a single pass (or ride along with a write)."""
    clean = F.size(errors) == 0
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(clean).alias("accepted_rows"),
        F.count_if(~clean).alias("quarantined_rows"),
        *[F.count_if(F.array_contains(errors, r.reason)).alias(f"reason_{i}") for i, r in enumerate(rules)],
        *[e.unexpected().alias(f"unexpected_{i}") for i, e in enumerate(expectations)],
    ]


def gate_status(quarantined_rows: Column, strict: Column) -> Column:
    return (
        F.when(quarantined_rows == 0, F.lit("PASS"))
        .when(strict, F.lit("FAIL"))
        .otherwise(F.lit("PASS_WITH_QUARANTINE"))
    )


def measured(df: DataFrame, rules: Sequence[Rule], expectations: Sequence[Expectation]) -> DataFrame:
    return with_errors(df, rules).agg(*gate_measures(rules, expectations))


def reason_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per failure reason (a row counts under each of its reasons), seen reasons only."""
    one = measured(df, rules, ())
    pairs = F.array(*[
        F.struct(F.lit(r.reason).alias("reason"), F.col(f"reason_{i}").alias("n_rows")) for i, r in enumerate(rules)
    ])
    return one.select(F.inline(pairs)).where(F.col("n_rows") > 0)


def expectation_results(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: position, name, column, unexpected count, success."""
    one = df.agg(*[e.unexpected().alias(f"unexpected_{i}") for i, e in enumerate(expectations)])
    results = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(e.name).alias("expectation"),
            F.lit(e.column).alias("column_name"),
            F.col(f"unexpected_{i}").alias("unexpected"),
            (F.col(f"unexpected_{i}") == 0).alias("success"),
        )
        for i, e in enumerate(expectations)
    ])
    return one.select(F.inline(results))


def gate_report(
    df: DataFrame,
    rules: Sequence[Rule],
    expectations: Sequence[Expectation],
    *,
    run_id: str,
    strict: bool = False,
) -> DataFrame:
    """The run report as one row."""
    passed = sum((F.when(F.col(f"unexpected_{i}") == 0, 1).otherwise(0) for i in range(len(expectations))), F.lit(0))
    return measured(df, rules, expectations).select(
        F.lit(run_id).alias("run_id"),
        gate_status(F.col("quarantined_rows"), F.lit(strict)).alias("status"),
        F.lit(strict).alias("strict_mode"),
        "input_rows",
        "accepted_rows",
        "quarantined_rows",
        passed.alias("expectations_passed"),
        F.lit(len(expectations)).alias("expectations_total"),
    )


# ---- model constraints ---------------------------------------------------------------------


def constraint_violations(df: DataFrame, primary_key: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """Violations per constraint: key uniqueness, key completeness and any row predicates.

    Rows are folded to one per key value first (with map-side combining), so a key repeated
    very often is just one counter; ``unique_key`` counts the rows beyond the first per key.
    """
    per_key = df.groupBy(*primary_key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"_c{i}") for i, ok in enumerate(checks.values())],
    )
    missing = F.lit(False)
    for key in primary_key:
        missing = missing | F.col(key).isNull()
    totals = per_key.agg(
        F.sum(F.when(~missing, F.col("_n") - 1).otherwise(0)).alias("unique_key"),
        F.sum(F.when(missing, F.col("_n")).otherwise(0)).alias("key_not_null"),
        *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(checks))],
    )
    names = {"unique_key": "unique_key", "key_not_null": "key_not_null"}
    names |= {name: f"_c{i}" for i, name in enumerate(checks)}
    rows = F.array(*[
        F.struct(F.lit(name).alias("constraint_name"), F.coalesce(F.col(c), F.lit(0)).alias("violations"))
        for name, c in names.items()
    ])
    return totals.select(F.inline(rows))


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent, and how many child rows carry each.

    Child rows are counted per key before the anti join: a hot key is one row by then.
    """
    counted = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(pk).alias(fk)) if pk != fk else parent.select(fk)
    return counted.join(known, fk, "left_anti")
