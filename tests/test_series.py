import datetime as dt
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import fill_profile
from pulsegrid.operators import (
    as_columns, bucket_series, exact_median, fill_with_median, first_per_key, gap_report, hourly_profile, interpolated,
    latest_per_key, newest_row, offset_lookup, standardised, temporal_split, trailing_sum, with_neighbours,
)
from pulsegrid.plans.forecast import station_features
from pulsegrid.plans.stations import FEATURES

T0 = dt.datetime(2026, 3, 2)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_newest_with_equal_times_is_settled_by_the_other_columns(spark, rows):
    df = spark.createDataFrame([("a", at(0), 1), ("a", at(5), 2), ("a", at(5), 3), ("b", at(1), None)],
                               "k STRING, ts TIMESTAMP, v INT")
    for _ in range(3):
        assert rows(latest_per_key(df.repartition(5), ["k"], ["ts", "v"]), "k", "v") == [("a", 3), ("b", None)]
    assert rows(first_per_key(df, ["k"], ["ts", "v"]), "k", "v") == [("a", 1), ("b", None)]
    assert newest_row(df, ["ts", "v"]).head()["v"] == 3
    assert newest_row(df.limit(0), ["ts"]).count() == 0


def test_buckets_floor_time_and_skip_missing_keys(spark, rows):
    df = spark.createDataFrame(
        [("a", at(1), 10, None, 1), ("a", at(14), 12, "Paris", 2), ("a", at(14.5), 11, "Lyon", 2), ("a", at(15), 9, "X", 7),
         (None, at(1), 1, "N", 1)], "s STRING, ts TIMESTAMP, cap INT, zone STRING, bikes INT")
    got = rows(bucket_series(df, ["s"], "ts", "15 minutes", maxima=["cap"], firsts=["zone"], means=["bikes"]))
    assert got == [("a", at(0), 12, "Paris", 2), ("a", at(15), 9, "X", 7)]


def test_bucket_means_round_half_to_even(spark):
    df = spark.createDataFrame([("a", at(0), 2), ("a", at(1), 3), ("b", at(0), 3), ("b", at(1), 4)], "s STRING, ts TIMESTAMP, v INT")
    got = {r["s"]: r["v"] for r in bucket_series(df, ["s"], "ts", "15 minutes", means=["v"]).collect()}
    assert got == {"a": 2, "b": 4}


def test_lookup_uses_exact_offsets_not_rows(spark, rows):
    df = spark.createDataFrame([("a", at(0), 1), ("a", at(15), 2), ("a", at(60), 5), ("b", at(30), 9)], "s STRING, ts TIMESTAMP, v INT")
    got = rows(offset_lookup(df, ["s"], "ts", "v", {"lag_15": -900, "lag_45": -2700, "ahead_60": 3600}))
    assert got == [("a", at(0), 1, None, None, 5), ("a", at(15), 2, 1, None, None), ("a", at(60), 5, None, 2, None),
                   ("b", at(30), 9, None, None, None)]


def test_lookup_keeps_incomplete_rows_and_rejects_repeats(spark, rows):
    columns = "s STRING, ts TIMESTAMP, v INT, note STRING"
    df = spark.createDataFrame([("a", at(0), None, "x"), ("a", at(15), 2, None), ("a", None, 3, "y"), (None, at(0), 4, "z")], columns)
    got = rows(offset_lookup(df, ["s"], "ts", "v", {"lag": -900, "ahead": 900}))
    assert got == [(None, at(0), 4, "z", None, None), ("a", None, 3, "y", None, None), ("a", at(0), None, "x", None, 2),
                   ("a", at(15), 2, None, None, None)]
    with pytest.raises(Exception, match="not unique"):
        offset_lookup(df.union(df), ["s"], "ts", "v", {"lag": -900}).collect()


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_lookup_crosses_chunks(spark, monkeypatch, kind):
    monkeypatch.setattr("pulsegrid.operators.series.CHUNK_SECONDS", 3600)
    minutes = random.Random(7).sample(range(3000), 700)
    values = {(s, m): None if m % 11 == 0 else m * s for m in minutes for s in (1, 2)}
    df = spark.createDataFrame([(s, at(m), v) for (s, m), v in values.items()], f"s INT, ts {kind}, v INT")
    offsets = {"back": -900, "far": -86_400, "next": 60, "same": 0}
    got = {(r["s"], r["ts"]): tuple(r[c] for c in offsets) for r in offset_lookup(df, ["s"], "ts", "v", offsets).collect()}
    assert got == {(s, at(m)): tuple(values.get((s, m + seconds // 60)) for seconds in offsets.values()) for s, m in values}
    assert offset_lookup(df, ["s"], "ts", "v", {}).count() == len(values)


def test_lookup_sends_a_row_once_or_to_a_neighbouring_chunk(spark):
    df = spark.range(4000).select(F.lit("hot").alias("s"), F.timestamp_seconds(F.col("id") * 900).alias("ts"), "id")
    out = offset_lookup(df, ["s"], "ts", "id", {f"lag_{i}": -900 * i for i in range(1, 5)})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan and "HashAggregate" not in plan
    assert out.where("lag_4 = id - 4").count() == 3996


def test_gap_report_counts(spark):
    minutes = [0, 15, 30, 75, 4 * 1440]
    df = spark.createDataFrame([("a", at(m)) for m in minutes] + [("b", at(0))], "s STRING, ts TIMESTAMP")
    got = gap_report(df, ["s"], "ts", 900, 3600).head()
    assert (got["n_rows"], got["n_series"], got["n_steps"], got["n_exact_steps"]) == (6, 2, 4, 2)
    assert got["n_with_target"] == 1
    assert (got["days_spanned"], got["days_missing"]) == (5, 3)


def test_split_is_relative_to_the_newest_row(spark):
    df = spark.createDataFrame([(at(1440 * d),) for d in range(5)], "ts TIMESTAMP")
    got = {r["ts"]: r["split"] for r in temporal_split(df, "ts", 2 * 86400).collect()}
    assert [got[at(1440 * d)] for d in range(5)] == ["train", "train", "train", "test", "test"]


def test_station_features_have_the_published_columns(spark):
    rows = [("s1", at(15 * i), 20 if i else None, "Paris" if i % 2 else None, i, 20 - i, 1, 2) for i in range(8)]
    df = spark.createDataFrame(rows, "stationcode STRING, ts_15min TIMESTAMP, capacity INT, "
                                     "nom_arrondissement_communes STRING, numbikesavailable BIGINT, numdocksavailable BIGINT, "
                                     "mechanical BIGINT, ebike BIGINT")
    got = {r["ts_15min"]: r for r in station_features(df).collect()}
    assert set(FEATURES) <= set(got[at(0)].asDict()) and len(FEATURES) == 17
    assert got[at(0)]["capacity"] == 20.0 and got[at(0)]["is_paris"] == 0 and got[at(15)]["is_paris"] == 1
    assert (got[at(60)]["lag_15"], got[at(60)]["lag_60"], got[at(60)]["roll_mean_lag"]) == (3, 0, 1.5)
    assert got[at(15)]["roll_mean_lag"] == 0 and got[at(0)]["roll_mean_lag"] is None
    assert (got[at(0)]["dow"], got[at(0)]["weekend"]) == (0, 0)       # a Monday


@pytest.mark.parametrize("values", [
    [3, 1, 2], [4, 1, 2, 3], [7], [5] * 50, [1] * 30 + [2] * 30, list(range(1000)), [1e9] + [0.001 * i for i in range(999)],
    [-5, None, 3, float("nan"), 8, 9], [float("inf"), *range(1000)], [float("-inf")] * 3 + [1, 2], [1.7e308, -1.7e308] * 300,
    [1e300] + [i / 7 for i in range(500)], [1.7e308, 1.6e308],
])
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v DOUBLE").repartition(3)
    known = [v for v in values if v is not None and v == v]
    ordered = sorted(map(float, known))
    low, high = ordered[(len(ordered) - 1) // 2], ordered[len(ordered) // 2]
    assert exact_median(df, "v").head()["median"] == (low if low == high else low / 2 + high / 2)


def test_rows_without_key_or_time_are_no_repeats(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), (None, at(0), 3), (None, at(0), 4), ("a", at(0), 5), ("a", at(15), 6)],
                               "k STRING, ts TIMESTAMP, v INT")
    got = offset_lookup(df, ["k"], "ts", "v", {"before": -900}).collect()
    assert sorted((r["v"], r["before"]) for r in got if r["before"] is not None) == [(6, 5)] and len(got) == 6


def test_median_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v DOUBLE")
    assert exact_median(df, "v").head()["median"] is None
    assert fill_with_median(spark.createDataFrame([(1,), (None,), (3,)], "v INT"), "v").where("v = 2").count() == 1


def _random_series(seed, n=400):
    pick = random.Random(seed)
    # one series holds most of the rows; long gaps leave whole chunks empty
    out, clock = [], {"hot": 0, "cold": 0, None: 0}
    for i in range(n):
        name = pick.choices(["hot", "cold", None], [8, 1, 1])[0]
        clock[name] += pick.choice([0, 1, 7, 60, 61, 3000])
        out.append((name, T0 + dt.timedelta(seconds=clock[name]), i, pick.randint(0, 9)))
    return out


@pytest.mark.parametrize("chunk", [60, 3600, 10**9])
def test_neighbours_match_a_plain_window(spark, chunk):
    data = _random_series(1)
    df = spark.createDataFrame(data, "s STRING, ts TIMESTAMP, i INT, v INT")
    got = {r["i"]: (r["prev"] and r["prev"]["v"], r["next"] and r["next"]["ts"])
           for r in with_neighbours(df, ["s"], "ts", ["v"], ties=["i"], chunk_seconds=chunk).collect()}
    frame = pd.DataFrame(data, columns=["s", "ts", "i", "v"]).sort_values(["ts", "i"])
    groups = frame.groupby("s", dropna=False)
    frame["p"], frame["n"] = groups["v"].shift(1), groups["ts"].shift(-1)
    want = {r.i: (None if pd.isna(r.p) else int(r.p), None if pd.isna(r.n) else r.n.to_pydatetime()) for r in frame.itertuples()}
    assert got == want


@pytest.mark.parametrize("chunk,window", [(60, 10), (60, 300), (3600, 61), (10**9, 300)])
def test_trailing_sum_matches_brute_force(spark, chunk, window):
    data = _random_series(2, 200)
    df = spark.createDataFrame(data, "s STRING, ts TIMESTAMP, i INT, v INT")
    got = {r["i"]: r["x"] for r in trailing_sum(df, ["s"], "ts", "v", window, "x", chunk_seconds=chunk).collect()}
    span = dt.timedelta(seconds=window)
    want = {i: sum(v2 for s2, t2, _, v2 in data if s2 == s and t - span < t2 <= t) for s, t, i, _ in data}
    assert got == want


def test_trailing_sum_adds_no_frame_again(spark):
    data = [("a", at(i * 20), float(i)) for i in range(9)] + [("a", at(170), None), ("a", None, 1.0), (None, at(0), None)]
    df = spark.createDataFrame(data, "s STRING, ts TIMESTAMP, v DOUBLE")
    out = trailing_sum(df.withColumn("v", F.when(F.col("v") == 2, float("inf")).otherwise(F.col("v"))), ["s"], "ts", "v", 3600, "x")
    got = {(r["s"], r["ts"]): r["x"] for r in out.collect()}
    inf = float("inf")
    assert got == {("a", at(i * 20)): x for i, x in enumerate([0.0, 1.0, inf, inf, inf, 12.0, 15.0, 18.0, 21.0])} | {
        ("a", at(170)): 21.0, (None, at(0)): None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]*),", plan)
    assert len(frames) == 2 and all("unboundedpreceding" in f for f in frames)      # running sums only


def test_profile_fill_matches_pandas(spark):
    pick = random.Random(3)
    profiles = [[None if pick.random() < 0.4 else round(pick.random(), 3) for _ in range(24)] for _ in range(40)]
    profiles += [[None] * 23 + [0.5], [0.25] + [None] * 23, [None] * 5 + [1.0] + [None] * 12 + [0.0] + [None] * 5]
    df = spark.createDataFrame(list(enumerate(profiles)), "i INT, p ARRAY<DOUBLE>")
    got = {r["i"]: r["f"] for r in df.select("i", fill_profile(F.col("p")).alias("f")).collect()}
    want = pd.DataFrame(profiles, dtype=float).interpolate(axis=1, limit_direction="both")
    for i in range(len(profiles)):
        assert np.allclose(np.array(got[i], dtype=float), want.iloc[i].to_numpy(), equal_nan=True)


def test_profiles_need_enough_hours(spark):
    data = [(f"n{n}", at(60 * h), float(h)) for n in (17, 18, 24) for h in range(n)]
    df = spark.createDataFrame(data, "s STRING, ts TIMESTAMP, r DOUBLE")
    wide = hourly_profile(df, "s", "ts", "r", 18)
    assert {r["s"] for r in wide.collect()} == {"n18", "n24"}
    filled = {r["s"]: r for r in as_columns(interpolated(wide, "s"), "s").collect()}
    assert filled["n18"]["h23"] == 17.0 and filled["n24"]["h23"] == 23.0


def test_constant_columns_standardise_to_zero(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "k STRING, x DOUBLE, y DOUBLE")
    assert rows(standardised(df, ["x", "y"])) == [("a", -1.0, 0.0), ("b", 1.0, 0.0)]
