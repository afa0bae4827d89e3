"""Every commit of the streaming queries as a table that outlives them.

A listener appends one line per commit, keyed by query, run and batch, below ``day=`` folders that retention can
drop whole (``sources.retain_days`` with ``column="day"``).  A file is named by what it holds, so writing it again
changes nothing.
"""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener,
)

_LINE = "id STRING, runId STRING, name STRING, batchId BIGINT, timestamp STRING, numInputRows BIGINT, durationMs MAP<STRING, BIGINT>"
_FIELDS = ("id", "runId", "name", "batchId", "timestamp", "numInputRows", "durationMs")
_TABLE = "query STRING, query_id STRING, run_id STRING, batch_id BIGINT, committed_at TIMESTAMP, input_rows BIGINT, seconds DOUBLE, day DATE"


class ProgressLog(StreamingQueryListener):
    """Listener that keeps the commits of all queries of a session below ``root``.

    ``every`` commits of a run go to one file; those not yet written are written when the run ends and are lost if
    the driver dies.  The default loses none.  Use it as a context manager, or add and remove it yourself.
    """

    def __init__(self, spark: SparkSession, root: str, every: int = 1):
        self._spark, self._root, self._every = spark, root.rstrip("/"), every
        self._waiting: dict[tuple[str, str], list[dict]] = defaultdict(list)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *problem) -> None:
        self._spark.streams.removeListener(self)
        for key in list(self._waiting):
            self._write(key)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        line = json.loads(event.progress.json)
        key = (line["id"], line["runId"])
        held = self._waiting[key]
        if held and held[0]["timestamp"][:10] != line["timestamp"][:10]:
            self._write(key)                       # a file belongs to one day
        self._waiting[key].append({field: line.get(field) for field in _FIELDS})
        if len(self._waiting[key]) >= self._every:
            self._write(key)

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._write((str(event.id), str(event.runId)))
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Until all commits of an ended query are written; listeners hear of them a little later."""
        return self._ended[str(query.runId)].wait(seconds)

    def _write(self, key: tuple[str, str]) -> None:
        lines = self._waiting.pop(key, [])
        if not lines:
            return
        first, last = lines[0], lines[-1]
        path = self._spark._jvm.org.apache.hadoop.fs.Path(
            f"{self._root}/day={first['timestamp'][:10]}/{key[0]}-{key[1]}-{first['batchId']}-{last['batchId']}.json")
        out = path.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray("".join(json.dumps(line) + "\n" for line in lines).encode()))
        finally:
            out.close()


def progress_history(spark: SparkSession, root: str, since: date | None = None) -> DataFrame:
    """Commits in ``root``: query (its name, else its id), query_id, run_id, batch_id, committed_at, input_rows, seconds, day.

    ``since`` reads only the days from then on.  A batch that ran again after a failure is there once per run.  Feed
    it to ``operators.stalls`` by query: pauses across restarts are seen too.
    """
    try:
        rows = spark.read.schema(_LINE + ", day DATE").json(root)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _TABLE)
    if since is not None:
        rows = rows.where(F.col("day") >= F.lit(since))
    took = F.col("durationMs")["triggerExecution"] / 1000.0
    # a trigger's time is when it began; it committed when it had run
    begun = F.to_timestamp("timestamp")
    return rows.select(
        F.coalesce("name", "id").alias("query"), F.col("id").alias("query_id"), F.col("runId").alias("run_id"),
        F.col("batchId").alias("batch_id"), (begun + F.make_dt_interval(secs=F.coalesce(took, F.lit(0.0)))).alias("committed_at"),
        F.col("numInputRows").alias("input_rows"), took.alias("seconds"), "day",
    ).dropDuplicates(["query_id", "run_id", "batch_id"])
