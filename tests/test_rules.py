import pytest
from pyspark.sql import functions as F, types as T

from pulsegrid.functions import blank, cap_at, number_or_null, percent_of, row_mean, to_whole
from pulsegrid.operators import (
    accepted, check_contract, constraint_violations, expectation_results, keep_in_range, orphan_keys, quarantined,
    reason_counts, require_columns, with_errors,
)
from pulsegrid.plans import gate
from pulsegrid.plans.stations import CURATED_CONTRACT, GATE_COLUMNS, GATE_EXPECTATIONS, GATE_RULES

LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()


def schema(**columns):
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


def test_contract_accepts_a_matching_schema_with_extra_columns():
    given = schema(**CURATED_CONTRACT, more=TEXT)
    assert check_contract(given, CURATED_CONTRACT) == (True, [], [])


def test_contract_names_missing_columns_in_order():
    check = check_contract(schema(stationcode=TEXT, capacity=LONG), CURATED_CONTRACT)
    assert not check.ok
    assert check.missing == ["numbikesavailable", "numdocksavailable", "taux_occupation"]


def test_contract_names_wrong_types():
    given = schema(**(CURATED_CONTRACT | {"taux_occupation": TEXT, "capacity": T.IntegerType()}))
    ok, missing, wrong = check_contract(given, CURATED_CONTRACT)
    assert (ok, missing) == (False, [])
    assert wrong == [("capacity", "bigint", "int"), ("taux_occupation", "double", "string")]


def test_cap_leaves_unknown_unknown(spark, rows):
    df = spark.createDataFrame([("A", 34.6), ("B", 100.0), ("C", 137.5), ("D", 0.0), ("E", None)], "s STRING, r DOUBLE")
    assert rows(df.select("s", cap_at("r"))) == [("A", 34.6), ("B", 100.0), ("C", 100.0), ("D", 0.0), ("E", None)]
    assert rows(df.where("s = 'E'").select(cap_at("r", missing_is_limit=True))) == [(100.0,)]


def test_range_keeps_the_bounds_only(spark, rows):
    df = spark.createDataFrame(
        [("A", 1), ("B", 35), ("C", 100), ("D", 0), ("E", 1613), ("F", None)], "s STRING, capacity BIGINT")
    assert rows(keep_in_range(df, "capacity"), "s") == [("A",), ("B",), ("C",)]


def test_range_drops_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (50.0,)], "v DOUBLE")
    assert keep_in_range(df, "v").count() == 1


def test_rate_of_zero_or_missing_whole_is_null(spark, rows):
    df = spark.createDataFrame([(1, 5, 0), (2, 5, None), (3, None, 5), (4, 1, 3)], "i INT, b INT, c INT")
    assert rows(df.select("i", percent_of("b", "c"))) == [(1, None), (2, None), (3, None), (4, 33.3)]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" 12 ", 2.5, None)], "t STRING, h DOUBLE, n DOUBLE")
    got = df.select(
        number_or_null("t"), number_or_null(F.lit("abc")), number_or_null(F.lit(float("nan"))), to_whole("h"),
        to_whole(F.lit(3.5)), row_mean("h", "n"), row_mean("n"), blank(F.lit(" \t\n")), blank(F.lit(None)), blank("t"),
    ).head()
    assert tuple(got) == (12.0, None, None, 2, 4, 2.5, None, True, True, False)


EXPECTED = {
    None: "stationcode_null_or_empty",
    "BAD-2": "taux_occupation_out_of_range|numbikesavailable_greater_than_capacity",
    "BAD-3": "capacity_out_of_range|numbikesavailable_out_of_range|meteo_temp_out_of_range|"
             "numbikesavailable_greater_than_capacity",
}


def test_demo_rows_are_routed(spark):
    checked = with_errors(gate.demo_rows(spark), GATE_RULES)
    assert accepted(checked).count() == 5
    assert {r["stationcode"]: r["_quality_errors"] for r in quarantined(checked).collect()} == EXPECTED
    counts = {r["reason"]: r["n_rows"] for r in reason_counts(gate.demo_rows(spark), GATE_RULES).collect()}
    assert counts.pop("numbikesavailable_greater_than_capacity") == 2
    assert set(counts.values()) == {1} and len(counts) == 5


def test_missing_breaks_a_rule_but_not_an_expectation(spark):
    df = spark.createDataFrame(
        [("a", None, None, None, float("nan"))],
        "stationcode STRING, taux_occupation DOUBLE, capacity INT, numbikesavailable INT, meteo_temp DOUBLE")
    errors = with_errors(df, GATE_RULES).head()["_errors"]
    assert errors == ["taux_occupation_out_of_range", "capacity_out_of_range", "numbikesavailable_out_of_range",
                      "meteo_temp_out_of_range"]
    assert all(r["success"] for r in expectation_results(df, GATE_EXPECTATIONS).collect())


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="capacity, meteo_temp"):
        require_columns(gate.demo_rows(spark).drop("meteo_temp", "capacity"), GATE_COLUMNS)


@pytest.mark.parametrize("strict,status,code", [(False, "PASS_WITH_QUARANTINE", 0), (True, "FAIL", 1)])
def test_gate_writes_both_sides_and_a_report(spark, tmp_path, strict, status, code):
    demo = gate.demo_rows(spark)
    demo.write.parquet(str(tmp_path / "in"))
    outcome = gate.run_gate(
        spark.read.parquet(str(tmp_path / "in")), accepted_path=f"{tmp_path}/ok", quarantine_path=f"{tmp_path}/bad",
        report_path=f"{tmp_path}/report", run_id="r1", strict=strict)
    assert (outcome.status, outcome.exit_code) == (status, code)
    assert spark.read.parquet(f"{tmp_path}/ok/r1").columns == demo.columns
    assert spark.read.parquet(f"{tmp_path}/ok/r1").count() == 5
    assert spark.read.parquet(f"{tmp_path}/bad/r1").count() == 3
    report = spark.read.json(f"{tmp_path}/report").head().asDict(recursive=True)
    assert report["counts"] == {"input_rows": 8, "accepted_rows": 5, "quarantined_rows": 3}
    assert report["expectations"]["passed"] == 1 and report["expectations"]["total"] == 6
    assert report["invalid_reason_counts"]["numbikesavailable_greater_than_capacity"] == 2
    assert len(report["source"]["files"]) >= 1


def test_gate_without_bad_rows_passes_and_writes_no_quarantine(spark, tmp_path):
    good = gate.demo_rows(spark).where("stationcode LIKE '100%'")
    outcome = gate.run_gate(good, accepted_path=f"{tmp_path}/ok", quarantine_path=f"{tmp_path}/bad",
                            report_path=f"{tmp_path}/report", run_id="r2", strict=True)
    assert (outcome.status, outcome.exit_code) == ("PASS", 0)
    assert not (tmp_path / "bad").exists()


def test_gate_without_good_rows_writes_no_accepted_folder(spark, tmp_path):
    bad = gate.demo_rows(spark).where("stationcode IS NULL")
    outcome = gate.run_gate(bad, accepted_path=f"{tmp_path}/ok", quarantine_path=f"{tmp_path}/bad",
                            report_path=f"{tmp_path}/report", run_id="r")
    assert outcome.status == "PASS_WITH_QUARANTINE"
    assert not (tmp_path / "ok" / "r").exists() and spark.read.parquet(f"{tmp_path}/bad/r").count() == 1


def test_gate_command(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(gate.SparkSession, "builder", type("B", (), {
        "appName": lambda self, _: self, "getOrCreate": lambda self: spark})())
    paths = [f"--{n}-path={tmp_path}/{n}" for n in ("input", "accepted", "quarantine", "report")]
    assert gate.main([*paths, "--demo", "--run-id=r"]) == 0
    assert "PASS_WITH_QUARANTINE" in capsys.readouterr().out
    assert gate.main([*paths, "--strict"]) == 1
    empty = tmp_path / "empty"
    empty.mkdir()
    assert gate.main([f"--input-path={empty}", *paths[1:]]) == 1


def test_constraints_and_orphans(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, -1), (2, 5), (None, 5), (None, None)], "k INT, v INT")
    got = dict(rows(constraint_violations(df, ["k"], {"not_negative": F.col("v") >= 0})))
    assert got == {"unique_key": 1, "key_not_null": 2, "not_negative": 2}
    parents = spark.createDataFrame([(1,)], "id INT")
    assert rows(orphan_keys(df, "k", parents, "id")) == [(2, 1)]
