"""Fixed values of the bike-station data model: payloads, table columns, rules and alerts.

Nothing else in the package knows these names; every operator takes columns as arguments.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType

from pulsegrid.operators.quality import Between, NotAbove, NotBlank, NotNull, RowCountBetween, Within

# JSON payloads.
STATUS_PAYLOAD = (
    "stationcode STRING, name STRING, is_installed STRING, is_renting STRING, is_returning STRING, "
    "numbikesavailable INT, numdocksavailable INT, mechanical INT, ebike INT, capacity INT, "
    "nom_arrondissement_communes STRING"
)
INFO_PAYLOAD = "stationcode STRING, name STRING, capacity INT, coordonnees_geo STRUCT<lon: DOUBLE, lat: DOUBLE>"
WEATHER_PAYLOAD = (
    "name STRING, main STRUCT<temp: DOUBLE, humidity: INT, pressure: INT>, wind STRUCT<speed: DOUBLE>, dt INT"
)

# Clean columns and where each comes from in the payload.
STATUS_FIELDS = {
    "stationcode": "stationcode",
    "numbikesavailable": "numbikesavailable",
    "numdocksavailable": "numdocksavailable",
    "mechanical": "mechanical",
    "ebike": "ebike",
    "capacity": "capacity",
    "nom_arrondissement_communes": "nom_arrondissement_communes",
}
INFO_FIELDS = {
    "stationcode": "stationcode",
    "name": "name",
    "capacity": "capacity",
    "latitude": "coordonnees_geo.lat",
    "longitude": "coordonnees_geo.lon",
}
WEATHER_FIELDS = {
    "temperature": "main.temp",
    "humidity": "main.humidity",
    "wind_speed": "wind.speed",
    "weather_ts": "dt",
}

# Contract of the curated table (columns a consumer needs, with types).
CURATED_CONTRACT = {
    "stationcode": StringType(),
    "capacity": LongType(),
    "numbikesavailable": LongType(),
    "numdocksavailable": LongType(),
    "taux_occupation": DoubleType(),
}

# Quality gate.
GATE_COLUMNS = ["stationcode", "taux_occupation", "capacity", "numbikesavailable", "meteo_temp"]
GATE_RULES = [
    NotBlank("stationcode", "stationcode_null_or_empty"),
    Within("taux_occupation", 0, 100, "taux_occupation_out_of_range"),
    Within("capacity", 0, 200, "capacity_out_of_range"),
    Within("numbikesavailable", 0, 200, "numbikesavailable_out_of_range"),
    Within("meteo_temp", -30, 50, "meteo_temp_out_of_range"),
    NotAbove("numbikesavailable", "capacity", "numbikesavailable_greater_than_capacity"),
]
GATE_EXPECTATIONS = [
    RowCountBetween(1, 100_000),
    NotNull("stationcode"),
    Between("taux_occupation", 0, 100),
    Between("capacity", 0, 200),
    Between("numbikesavailable", 0, 200),
    Between("meteo_temp", -30, 50),
]

# Forecast horizons in minutes, lags in minutes, feature columns.
HORIZONS = {"H+1": 60, "H+3": 180, "H+24": 1440}
LAGS = (15, 30, 45, 60)
FEATURES = [
    "numbikesavailable", "numdocksavailable", "mechanical", "ebike", "capacity", "taux_occ",
    "lag_15", "lag_30", "lag_45", "lag_60", "roll_mean_lag",
    "hour", "dow", "weekend", "sin_t", "cos_t", "is_paris",
]
