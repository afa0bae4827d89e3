"""Stored partial states against the operators over all rows."""

import datetime as dt
import random
from decimal import Decimal

from pulsegrid.operators import bucket_series, series_extent
from pulsegrid.streaming import BucketSpec, ExtentSpec, fold, merge_batch, read_states

T0 = dt.datetime(2026, 3, 2, 8)
ROWS = "station long, zone string, ts timestamp_ntz, docks int, kind string, bikes decimal(12,2)"
SPEC = BucketSpec(["station", "zone"], "ts", "15 minutes", maxima=["docks"], firsts=["kind"], means=["bikes"])
EXTENT = ExtentSpec("station", "ts")


def readings(seed, n, missing=0.1):
    draw = random.Random(seed)

    def maybe(value):
        return None if draw.random() < missing else value

    return [(maybe(draw.choice([1, 2, 40_000, 70_000])), maybe("a"), maybe(T0 + dt.timedelta(seconds=draw.randint(0, 9000))),
             maybe(draw.randint(0, 50)), maybe(draw.choice("xyz")), maybe(Decimal(draw.randint(0, 4000)) / 100)) for _ in range(n)]


def test_any_cut_and_any_fold_gives_the_whole(spark, tmp_path, rows):
    batches = [spark.createDataFrame(readings(i, 120), ROWS) for i in range(3)]
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    expected = bucket_series(whole, ["station", "zone"], "ts", "15 minutes", maxima=["docks"], firsts=["kind"], means=["bikes"])
    for folds in ((), (0,), (0, 1, 2)):
        for spec, wanted in ((SPEC, expected), (EXTENT, series_extent(whole, ["station"], "ts"))):
            root = f"{tmp_path}/{type(spec).__name__}-{len(folds)}"
            for number, batch in enumerate(batches):
                merge_batch(batch, number, root, spec)
                merge_batch(batch, number, root, spec)              # run again after a failure
                if number in folds:
                    assert fold(spark, root, spec, number) is not None and fold(spark, root, spec, number) is None
            merge_batch(batches[0], 0, root, spec)
            found = spec.finish(read_states(spark, root, spec))
            assert found.columns == wanted.columns
            assert rows(found) == rows(wanted)


def test_sums_keep_their_type(spark, tmp_path):
    root, batch = str(tmp_path), spark.createDataFrame(readings(5, 30), ROWS)
    for number in range(12):
        merge_batch(batch, number, root, SPEC)
        fold(spark, root, SPEC, number)
    assert read_states(spark, root, SPEC).schema["sum_bikes"].dataType.simpleString() == "decimal(22,2)"


def test_nothing_and_rows_of_no_bucket(spark, tmp_path):
    root = str(tmp_path)
    assert read_states(spark, root, SPEC) is None and fold(spark, root, SPEC, 0) is None
    merge_batch(spark.createDataFrame([(1, "a", None, 1, "x", None), (None, "a", T0, 1, "x", None)], ROWS), 0, root, SPEC)
    assert SPEC.finish(read_states(spark, root, SPEC)).count() == 0
    merge_batch(spark.createDataFrame([], ROWS), 0, f"{root}/extent", EXTENT)
    assert tuple(EXTENT.finish(read_states(spark, f"{root}/extent", EXTENT)).first()) == (0, 0, None, None)
