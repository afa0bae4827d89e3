import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.operators import check_contract
from pulsegrid.plans.curate import STATION_SPEC, curate
from pulsegrid.plans.stations import CURATED_CONTRACT

T0 = dt.datetime(2026, 3, 2, 8)
STATUS = ("stationcode STRING, numbikesavailable INT, numdocksavailable INT, mechanical INT, ebike INT, capacity INT, "
          "nom_arrondissement_communes STRING, ingestion_ts TIMESTAMP")
INFO = "stationcode STRING, name STRING, capacity INT, latitude DOUBLE, longitude DOUBLE, ingestion_ts TIMESTAMP"
WEATHER = "temperature DOUBLE, humidity INT, wind_speed DOUBLE, weather_ts INT, ingestion_ts TIMESTAMP"


def at(m):
    return T0 + dt.timedelta(minutes=m)


def zones(spark, weather=True):
    status = spark.createDataFrame([
        ("s1", 5, 15, 3, 2, 20, "Paris", at(0)), ("s1", 10, 10, 5, 5, 20, "Paris", at(1)),
        ("s2", 30, 0, 10, 20, 20, "Lyon", at(1)),           # more bikes than docks
        ("s3", 5, 5, 5, 0, 1613, "Paris", at(1)), ("s3", 5, 5, 5, 0, 10, "Paris", at(0)),
        ("s4", 0, 0, 0, 0, 0, "Paris", at(1)),
        ("s5", None, 5, 0, 0, 10, None, at(1)),
        (None, 1, 1, 1, 1, 10, "Paris", at(1)),
    ], STATUS)
    info = spark.createDataFrame([
        ("s1", "Old name", 20, 48.1, 2.1, at(0)), ("s1", "New name", 20, 48.1, 2.1, at(1)), ("s2", "Two", 20, 1.0, 2.0, at(0)),
    ], INFO)
    reports = [(11.0, 60, 3.0, 100, at(0)), (12.5, 61, 4.0, 200, at(0)), (None, 1, 1.0, None, at(1))]
    return status, info, spark.createDataFrame(reports if weather else [], WEATHER)


def result(spark, **kwargs):
    return {r["stationcode"]: r for r in curate(*zones(spark, **kwargs)).collect()}


def test_snapshot_rows(spark):
    got = result(spark)
    assert set(got) == {"s1", "s2", "s5"}       # implausible capacity, zero capacity and NULL key are gone
    assert got["s1"]["taux_occupation"] == 50.0 and got["s2"]["taux_occupation"] == 100.0
    assert got["s5"]["taux_occupation"] is None
    assert {r["meteo_temp"] for r in got.values()} == {12.5}


def test_renamed_station_does_not_multiply_rows(spark):
    status, info, weather = zones(spark)
    out = curate(status, info.unionByName(info).unionByName(info), weather)
    assert out.count() == 3
    assert out.where("stationcode = 's1'").head()["name"] == "New name"
    assert out.where("stationcode = 's5'").head()["name"] is None


def test_missing_weather_keeps_the_stations(spark):
    got = result(spark, weather=False)
    assert set(got) == {"s1", "s2", "s5"} and got["s1"]["meteo_temp"] is None


def test_snapshot_honours_its_contract(spark):
    out = curate(*zones(spark))
    assert out.columns == list(STATION_SPEC.output)
    assert check_contract(out, CURATED_CONTRACT).ok


def test_time_of_calculation_can_be_given(spark):
    out = curate(*zones(spark), as_of=F.lit(T0))
    assert {r["date_calcul"] for r in out.collect()} == {T0}
