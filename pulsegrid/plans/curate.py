"""The serving snapshot: newest state per entity, enriched, rated and cleaned."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions import cap_at, percent_of
from pulsegrid.operators.latest import latest_per_key, newest_as_struct
from pulsegrid.operators.quality import keep_in_range


@dataclass(frozen=True)
class CurateSpec:
    """Column roles of a curated snapshot."""

    key: str
    newest_by: Sequence[str]                     # time first, then tie-breakers
    part: str                                    # numerator of the occupancy rate
    whole: str                                   # denominator, also range-checked
    reference_fields: Sequence[str]
    reference_newest_by: Sequence[str]
    context_newest_by: Sequence[str]
    context_fields: dict[str, str]               # output column -> context column
    rate: str = "rate"
    bounds: tuple[float, float] = (1, 100)
    rate_limit: float = 100.0
    missing_rate_is_limit: bool = False
    output: Sequence[str] = field(default_factory=tuple)
    as_bigint: Sequence[str] = field(default_factory=tuple)


STATION_SPEC = CurateSpec(
    key="stationcode",
    newest_by=["ingestion_ts", "numbikesavailable", "numdocksavailable", "mechanical", "ebike", "capacity",
               "nom_arrondissement_communes"],
    part="numbikesavailable",
    whole="capacity",
    reference_fields=["name", "latitude", "longitude"],
    reference_newest_by=["ingestion_ts", "name", "latitude", "longitude"],
    context_newest_by=["weather_ts", "ingestion_ts", "temperature", "wind_speed", "humidity"],
    context_fields={"meteo_temp": "temperature", "meteo_vent": "wind_speed", "meteo_humidite": "humidity"},
    rate="taux_occupation",
    # Columns of the curated table, in stored order.
    output=["stationcode", "name", "latitude", "longitude", "numbikesavailable", "mechanical", "ebike",
            "numdocksavailable", "capacity", "taux_occupation", "nom_arrondissement_communes",
            "meteo_temp", "meteo_vent", "meteo_humidite", "date_calcul"],
    as_bigint=["numbikesavailable", "mechanical", "ebike", "numdocksavailable", "capacity"],
)


def curate_latest(
    latest: DataFrame, reference: DataFrame, context: DataFrame, spec: CurateSpec, as_of: Column | None = None
) -> DataFrame:
    """Enrich and clean rows that are already one per key."""
    known = latest.where(F.col(spec.key).isNotNull())
    # one reference row per key, so the join cannot multiply states; Spark broadcasts that side
    # only if its size is below the configured threshold
    facts = latest_per_key(
        reference.select(spec.key, *dict.fromkeys([*spec.reference_fields, *spec.reference_newest_by])),
        [spec.key], spec.reference_newest_by,
    ).select(spec.key, *spec.reference_fields)
    clash = [c for c in spec.reference_fields if c in known.columns]
    joined = known.drop(*clash).join(facts, spec.key, "left")
    context_row = newest_as_struct(context, spec.context_newest_by, spec.context_fields)
    rate = cap_at(percent_of(spec.part, spec.whole), spec.rate_limit, spec.missing_rate_is_limit)
    out = (
        keep_in_range(joined, spec.whole, *spec.bounds)
        .withColumn("_context", context_row)
        .withColumns({name: F.col(f"_context.{name}") for name in spec.context_fields})
        .drop("_context")
        .withColumn(spec.rate, rate)
        .withColumn("date_calcul", F.current_timestamp() if as_of is None else as_of)
        .withColumns({c: F.col(c).cast("bigint") for c in spec.as_bigint})
    )
    return out.select(*spec.output) if spec.output else out


def curate(
    status: DataFrame, reference: DataFrame, context: DataFrame, spec: CurateSpec = STATION_SPEC,
    as_of: Column | None = None,
) -> DataFrame:
    """Newest state per key, left-joined with its reference row and the newest context row,
    with a capped occupancy rate and only plausible capacities.

    The range check comes after "newest": an implausible newest state removes the entity
    instead of reviving an older one.
    """
    newest = latest_per_key(status.where(F.col(spec.key).isNotNull()), [spec.key], spec.newest_by)
    return curate_latest(newest, reference, context, spec, as_of)
