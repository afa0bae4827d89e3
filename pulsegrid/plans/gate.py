"""Quality gate as a job: read, check, route, report.  ``python -m pulsegrid.plans.gate --help``"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pulsegrid.functions import digest_sum, row_digest
from pulsegrid.operators import quality as q
from pulsegrid.sources.files import mixed_folder, source_files

from .stations import GATE_COLUMNS, GATE_EXPECTATIONS, GATE_RULES


class GateOutcome(NamedTuple):
    status: str
    report: DataFrame
    exit_code: int


def default_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")


def run_gate(
    df: DataFrame,
    *,
    accepted_path: str,
    quarantine_path: str,
    report_path: str,
    run_id: str | None = None,
    strict: bool = False,
    rules: Sequence[q.Rule] = GATE_RULES,
    expectations: Sequence[q.Expectation] = GATE_EXPECTATIONS,
    required: Sequence[str] = GATE_COLUMNS,
    input_path: str | None = None,
) -> GateOutcome:
    """Split ``df`` into accepted and quarantined rows below ``<path>/<run_id>`` and write a report.

    The numbers of the report are observed while the accepted rows are written, so they do not
    cost another pass; neither side is left behind without rows.
    """
    spark = df.sparkSession
    run_id = run_id or default_run_id()
    checked = q.with_errors(q.require_columns(df, required), rules)
    good_dir, bad_dir = f"{accepted_path.rstrip('/')}/{run_id}", f"{quarantine_path.rstrip('/')}/{run_id}"

    seen = Observation()
    fingerprint = digest_sum(row_digest(df.columns)).alias("checksum")
    observed = checked.observe(seen, *q.gate_measures(rules, expectations), fingerprint)
    q.accepted(observed).write.mode("overwrite").parquet(good_dir)
    m = seen.get
    if not m["accepted_rows"]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(good_dir)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if m["quarantined_rows"]:
        q.quarantined(checked).write.mode("overwrite").parquet(bad_dir)
    for kept, path in ((m["accepted_rows"], good_dir), (m["quarantined_rows"], bad_dir)):
        if kept and spark.read.parquet(path).count() != kept:
            raise RuntimeError(f"{path} does not hold the {kept} rows that were routed to it")

    status = "PASS" if not m["quarantined_rows"] else ("FAIL" if strict else "PASS_WITH_QUARANTINE")
    results = [
        (e.name, e.column, int(m[f"unexpected_{i}"]), not m[f"unexpected_{i}"]) for i, e in enumerate(expectations)
    ]
    reasons = {r.reason: int(m[f"reason_{i}"]) for i, r in enumerate(rules) if m[f"reason_{i}"]}
    report = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("generated_at_utc"),
        F.lit(status).alias("status"),
        F.lit(strict).alias("strict_mode"),
        F.struct(
            F.lit(input_path).alias("input_path"),
            F.array(*[F.lit(f) for f in source_files(df)]).cast("array<string>").alias("files"),
            F.lit(int(m["input_rows"])).cast("bigint").alias("rows"),
            F.lit(m["checksum"]).alias("checksum"),
        ).alias("source"),
        F.struct(*[F.lit(int(m[c])).cast("bigint").alias(c)
                   for c in ("input_rows", "accepted_rows", "quarantined_rows")]).alias("counts"),
        F.struct(
            F.lit(good_dir if m["accepted_rows"] else None).cast("string").alias("accepted_path"),
            F.lit(bad_dir if m["quarantined_rows"] else None).cast("string").alias("quarantine_path"),
            F.lit(report_path).alias("report_path"),
        ).alias("outputs"),
        F.create_map(*[F.lit(x) for pair in reasons.items() for x in pair]).cast("map<string,bigint>")
        .alias("invalid_reason_counts"),
        F.struct(
            F.lit(sum(r[3] for r in results)).alias("passed"),
            F.lit(len(results)).alias("total"),
            F.array(*[
                F.struct(F.lit(a).alias("expectation"), F.lit(b).alias("column"), F.lit(c).alias("unexpected"),
                         F.lit(d).alias("success"))
                for a, b, c, d in results
            ]).alias("results"),
        ).alias("expectations"),
    )
    report.write.mode("overwrite").json(report_path)
    return GateOutcome(status, spark.read.json(report_path), 1 if status == "FAIL" else 0)


def demo_rows(spark: SparkSession) -> DataFrame:
    """Eight rows, five of them valid."""
    rows = [
        ("1001", 20.0, 30, 6, 18.2), ("1002", 50.0, 40, 20, 19.1), ("1003", 80.0, 25, 20, 17.8),
        ("1004", 0.0, 15, 0, 21.0), ("1005", 100.0, 12, 12, 16.4), (None, 45.0, 20, 9, 20.0),
        ("BAD-2", 120.0, 20, 30, 18.0), ("BAD-3", 30.0, -1, 250, 80.0),
    ]
    schema = "stationcode STRING, taux_occupation DOUBLE, capacity BIGINT, numbikesavailable BIGINT, meteo_temp DOUBLE"
    return spark.createDataFrame(rows, schema)


def main(argv: Sequence[str] | None = None) -> int:
    env = os.environ.get
    on = {"1", "true", "yes", "on"}
    parser = argparse.ArgumentParser(description="Check a table, quarantine bad rows, write a report")
    parser.add_argument("--input-path", default=env("QUALITY_INPUT_PATH"))
    parser.add_argument("--accepted-path", default=env("QUALITY_ACCEPTED_PATH"))
    parser.add_argument("--quarantine-path", default=env("QUALITY_QUARANTINE_PATH"))
    parser.add_argument("--report-path", default=env("QUALITY_REPORT_PATH"))
    parser.add_argument("--run-id", default=env("QUALITY_RUN_ID"))
    parser.add_argument("--demo", action="store_true", default=env("QUALITY_DEMO", "").strip().lower() in on)
    parser.add_argument("--strict", action="store_true", default=env("QUALITY_STRICT", "").strip().lower() in on)
    args = parser.parse_args(argv)
    for name in ("input_path", "accepted_path", "quarantine_path", "report_path"):
        if not getattr(args, name):
            parser.error(f"--{name.replace('_', '-')} is required")

    spark = SparkSession.builder.appName("quality-gate").getOrCreate()
    try:
        if args.demo:
            demo_rows(spark).write.mode("overwrite").parquet(args.input_path)
        outcome = run_gate(
            mixed_folder(spark, args.input_path),
            accepted_path=args.accepted_path, quarantine_path=args.quarantine_path, report_path=args.report_path,
            run_id=args.run_id, strict=args.strict, input_path=args.input_path,
        )
    except (ValueError, FileNotFoundError, RuntimeError) as problem:
        print(f"ERROR: {problem}", file=sys.stderr)
        return 1
    print(f"status={outcome.status}")
    return outcome.exit_code


if __name__ == "__main__":
    sys.exit(main())
