"""Named queries over the test tables, each with an independent SQL statement where one exists.

The tables stand in for telemetry: ``lineitem`` holds readings per part, ``part`` describes the
entities, ``events`` is a time series per user (``value``, and ``k`` inside ``props``).
"""

from . import audits, forecasting, messages, metrics, profiles, quality, serving, storage, streams, timeseries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "audits", "forecasting", "messages", "metrics", "profiles", "quality", "serving",
           "storage", "streams", "timeseries"]
