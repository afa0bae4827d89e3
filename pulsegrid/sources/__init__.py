from .files import alert_log, inventory, inventory_report, mixed_folder, skipped_files, small_files, source_files
from .footers import file_ranges, file_types
from .generations import Compaction, compact_live, drop_replaced, first_fit, live_files, manifest, packing_plan, read_live
from .layout import Selected, read_index, read_range, write_sorted
from .messages import bad_payloads, envelope, keyed_messages, kafka_stream, parquet_stream, payload_columns
from .objects import DamagedObject, backup_objects, compare_objects, object_manifest, read_manifest, restore_objects
from .promotion import promoted_schema, read_promoted, unreadable, wider
from .tables import (
    backup, compact, drop_expired_partitions, export_csv, format_sizes, prune_versions, publish, published_versions,
    read_published, retain_days, split_retention, verify_copy,
)

__all__ = [
    "DamagedObject", "backup_objects", "compare_objects", "object_manifest", "read_manifest", "restore_objects",
    "Compaction", "Selected", "compact_live", "drop_replaced", "file_ranges", "file_types", "first_fit", "live_files", "manifest",
    "packing_plan", "promoted_schema", "read_index", "read_live", "read_promoted", "read_range", "unreadable", "wider", "write_sorted",
    "alert_log", "backup", "bad_payloads", "compact", "drop_expired_partitions", "envelope", "export_csv", "format_sizes",
    "inventory", "inventory_report", "kafka_stream", "keyed_messages", "mixed_folder", "parquet_stream",
    "payload_columns", "prune_versions", "publish", "published_versions", "read_published", "retain_days", "skipped_files", "small_files", "source_files",
    "split_retention", "verify_copy",
]
