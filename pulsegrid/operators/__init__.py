from .audit import (
    content_manifest, delivery_audit, manifest_diff, recovery_point, table_checksum, write_integrity,
)
from .latest import first_per_key, latest_per_key, newest_as_struct, newest_row
from .median import exact_median, fill_with_median, median_of
from .metrics import (
    alert_episodes, alert_history, consumer_lag, counter_increase, counter_rate, gauge_latest, gauge_ratio, stalls,
)
from .neighbours import trailing_sum, with_neighbours
from .profiles import (
    as_array, as_columns, cluster_dayparts, cluster_profiles, cluster_summary, hourly_demand, hourly_profile, interpolated, standardised,
    zone_imbalance,
)
from .quality import (
    accepted, check_contract, constraint_violations, expectation_results, gate_report, keep_in_range, orphan_keys,
    quarantined, reason_counts, require_columns, with_errors,
)
from .series import bucket_series, gap_report, offset_lookup, series_extent, temporal_split

__all__ = [
    "accepted", "alert_episodes", "alert_history", "as_array", "as_columns", "bucket_series", "check_contract", "cluster_dayparts",
    "cluster_profiles", "cluster_summary", "constraint_violations", "consumer_lag", "content_manifest",
    "counter_increase", "counter_rate", "delivery_audit", "exact_median", "expectation_results", "fill_with_median",
    "first_per_key", "gap_report", "gate_report", "gauge_latest", "gauge_ratio", "hourly_demand", "hourly_profile",
    "interpolated", "keep_in_range", "latest_per_key", "manifest_diff", "median_of", "newest_as_struct",
    "newest_row", "offset_lookup", "orphan_keys", "quarantined", "reason_counts", "recovery_point",
    "require_columns", "series_extent", "stalls", "standardised", "table_checksum", "temporal_split",
    "trailing_sum", "with_errors", "with_neighbours", "write_integrity", "zone_imbalance",
]
