"""K-means over standardised daily profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from pulsegrid.operators.profiles import HOURS, as_columns, interpolated, standardised
from pulsegrid.session import scratch_path


ENTITIES_PER_TASK, FEWEST_TASKS = 20_000, 16  # of the profile table


def profile_columns(prefix: str = "h") -> list[str]:
    return [f"{prefix}{h}" for h in HOURS]


def cluster_entities(
    profiles: DataFrame, key: str, k: int = 4, restarts: int = 10, seed: int = 42, prefix: str = "h"
) -> DataFrame:
    """Label per entity from the best of ``restarts`` runs (lowest within-cluster cost).

    Label numbers are arbitrary; the labels are a table in the shared folder.  Only the profile table (one row per entity) is kept in
    memory, spilling to disk; each run is distributed over it, in as few tasks as the number of entities needs: a run
    is some twenty short jobs, and each of them starts every task twice.
    """
    columns = profile_columns(prefix)
    ready = standardised(as_columns(interpolated(profiles, key, prefix), key, prefix), columns)
    vectors = (
        VectorAssembler(inputCols=columns, outputCol="features").transform(ready).select(key, "features")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    held = [vectors]
    try:
        size, parts = vectors.select(F.spark_partition_id().alias("part")).agg(F.count("*"), F.count_distinct("part")).first()
        tasks = max(FEWEST_TASKS, -(-size // ENTITIES_PER_TASK))
        few = vectors if parts <= tasks else vectors.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(few)
        runs = [KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="cluster").fit(few)
                for i in range(restarts)]
        best = min(runs, key=lambda m: m.summary.trainingCost)
        # stored from the profiles held: a plan over them would work out each profile for every use of a label
        path = scratch_path(profiles.sparkSession, "clusters")
        best.transform(few).select(key, "cluster").write.parquet(path)
    finally:
        for table in reversed(held):
            table.unpersist()
    return profiles.sparkSession.read.parquet(path)


__all__: Sequence[str] = ["cluster_entities", "profile_columns"]
