from .alerts import LiveAlerts, apply_samples, late_samples, live_episodes, start_alerts
from .exact import ExactSpec, apply_batch, read_exact, start_exact
from .history import ProgressLog, progress_history
from .jobs import (
    JobFolders, clean_info, clean_status, clean_weather, deduplicated, latest_reference, progress_rows, run_curation, start_append,
    start_curated, start_raw, start_reference, start_station_clean, start_station_curated,
    start_station_raw, station_tables,
)
from .partials import BucketSpec, ExtentSpec, fold, merge_batch, read_states
from .resume import file_log, file_resume_audit, offset_log, resume_point, topic_positions, topic_resume_audit

__all__ = [
    "LiveAlerts", "apply_samples", "late_samples", "live_episodes", "start_alerts",
    "BucketSpec", "ExtentSpec", "fold", "merge_batch", "read_states",
    "ProgressLog", "progress_history",
    "file_log", "file_resume_audit", "offset_log", "resume_point", "topic_positions", "topic_resume_audit",
    "ExactSpec", "apply_batch", "read_exact", "start_exact",
    "JobFolders", "clean_info", "clean_status", "clean_weather", "deduplicated", "latest_reference", "progress_rows",
    "run_curation", "start_append", "start_curated", "start_raw", "start_reference",
    "start_station_clean", "start_station_curated", "start_station_raw", "station_tables",
]
