"""Regular time series per entity: buckets, exact-offset look-ups, splits and gap counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions import mean_of, to_whole

# a chunk of a look-up: at least so many seconds (sparse series make few rows a chunk) and so many longest offsets (at
# most about an eighth of the rows is copied into each neighbour)
CHUNK_SECONDS, CHUNK_OFFSETS = 7 * 86_400, 8


def shift(ts: Column, seconds: int) -> Column:
    """``ts`` moved by a number of seconds, for TIMESTAMP and TIMESTAMP_NTZ alike."""
    return ts + F.make_dt_interval(secs=F.lit(seconds))


def bucket_series(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    width: str,
    *,
    maxima: Sequence[str] = (),
    firsts: Sequence[str] = (),
    means: Sequence[str] = (),
    whole_means: bool = True,
    bucket: str = "ts_bucket",
) -> DataFrame:
    """Floor the time to ``width`` and aggregate per entity and bucket.

    Partial aggregation runs before the exchange, so a hot entity costs at most one row per
    map task and bucket.  Gaps stay gaps; rows without a key or time belong to no bucket.
    """
    complete = df.where(F.col(ts).isNotNull())
    for key in keys:
        complete = complete.where(F.col(key).isNotNull())
    measures = [F.max(c).alias(c) for c in maxima]
    for name in firsts:
        # "first non-missing in time order", stated through an order so that it is repeatable
        rank = F.when(F.col(name).isNotNull(), F.struct(F.col(ts), F.col(name)))
        measures.append(F.min_by(F.col(name), rank).alias(name))
    for name in means:
        mean = mean_of(name)
        measures.append((to_whole(mean) if whole_means else mean).alias(name))
    return (
        complete.withColumn(bucket, F.window(F.col(ts), width).start)
        .groupBy(*keys, bucket)
        .agg(*measures)
    )


def offset_lookup(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, offsets: Mapping[str, int]
) -> DataFrame:
    """Value of the same entity exactly ``offset`` seconds away, one new column per entry.

    ``offsets`` maps the new column to seconds (negative = past).  A missing reading gives
    NULL; this is not a row-based lag.  (keys, ts) must be unique, which is checked; rows without key or time
    pass through with NULL.

    One exchange does it all.  Time is cut into chunks much longer than the offsets; a row goes to its own
    chunk, and a copy of it to each other chunk with a time that will ask for it.  Inside (keys, chunk) each offset
    is a range frame of one point in time.  Nothing is joined, and a hot entity is spread over its chunks.
    """
    width = max([CHUNK_SECONDS, *(CHUNK_OFFSETS * abs(seconds) for seconds in offsets.values())])
    known = F.col(ts).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()

    def chunk(time: Column) -> Column:
        return F.floor(time.cast("timestamp").cast("long") / width)

    # rows without key or time never take part: they are spread, and only looked through
    placed = df.withColumn("_chunk", F.when(known, chunk(F.col(ts))).otherwise(F.monotonically_increasing_id()))
    asked = [chunk(shift(F.col(ts), -seconds)) for seconds in offsets.values()]
    # rows without a value have nothing to send; the first chunk is a row's own
    chunks = F.when(known & F.col(value).isNotNull(), F.array_distinct(F.array("_chunk", *asked))).otherwise(F.array("_chunk"))
    sent = placed.select(*df.columns, F.posexplode(chunks).alias("_nth", "_chunk"))
    keyed = ", ".join(_quoted(c) for c in (*keys, "_chunk"))

    def at_offset(measure: str, seconds: int) -> Column:
        bound = f"INTERVAL '{abs(seconds)}' SECOND {'PRECEDING' if seconds < 0 else 'FOLLOWING'}" if seconds else "CURRENT ROW"
        return F.expr(f"{measure} OVER (PARTITION BY {keyed} ORDER BY {_quoted(ts)} RANGE BETWEEN {bound} AND {bound})")

    whole = sent.select(
        *df.columns, "_nth", at_offset("count_if(_nth = 0)", 0).alias("_rows"),
        *[F.when(known, at_offset(f"max({_quoted(value)})", seconds)).alias(name) for name, seconds in offsets.items()],
    )
    repeated = F.raise_error(F.lit(f"offset_lookup: ({', '.join([*keys, ts])}) is not unique"))
    own = F.col("_nth") == 0
    single = F.when(own & known & (F.col("_rows") > 1), repeated.cast("boolean")).otherwise(own)
    return whole.where(single).select(*df.columns, *offsets)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def temporal_split(df: DataFrame, ts: str, holdout_seconds: int, label: str = "split") -> DataFrame:
    """Mark rows as ``train`` (up to the cut) or ``test``; the cut is max(ts) minus the hold-out."""
    cut = df.agg(shift(F.max(ts), -holdout_seconds).alias("cut")).scalar()
    return df.withColumn(label, F.when(F.col(ts) <= cut, F.lit("train")).otherwise(F.lit("test")))


def series_extent(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Row total, number of entities and covered period, as one row."""
    entity = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(entity).alias("n_series"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def gap_report(df: DataFrame, keys: Sequence[str], ts: str, step_seconds: int, target_seconds: int) -> DataFrame:
    """How complete a regular series is, as one row.

    Two neighbours on a regular grid are ``step`` apart exactly when both grid points exist,
    so the share of unbroken steps is a look-up count and needs no per-entity ordering.
    """
    looked = offset_lookup(
        df.select(*keys, ts).distinct().withColumn("_here", F.lit(1)),
        keys, ts, "_here", {"_prev": -step_seconds, "_target": target_seconds},
    )
    daily = looked.groupBy(*keys, F.to_date(ts).alias("_day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_prev").alias("unbroken"),
        F.count("_target").alias("targets"),
    )
    entity = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    totals = daily.agg(
        F.sum("n").alias("n_rows"),
        F.count_distinct(entity).alias("n_series"),
        F.sum("unbroken").alias("n_exact_steps"),
        F.sum("targets").alias("n_with_target"),
        F.count_distinct("_day").alias("days_present"),
        (F.date_diff(F.max("_day"), F.min("_day")) + 1).cast("bigint").alias("days_spanned"),
    )
    steps = F.col("n_rows") - F.col("n_series")
    return totals.select(
        "n_rows",
        "n_series",
        steps.alias("n_steps"),
        "n_exact_steps",
        F.try_divide(F.col("n_exact_steps"), steps).alias("exact_step_share"),
        "n_with_target",
        "days_spanned",
        (F.col("days_spanned") - F.col("days_present")).alias("days_missing"),
    )
