"""All named queries of the corpus operators."""

from . import (
    chat_windows_queries, filter_audit_queries, fingerprints_queries, html_text_queries, lm_scores_queries, metric_tree_queries,
    mixing_queries, near_dedup_queries, period_runs_queries, pieces_queries, pii_queries, quality_queries, token_files_queries,
)
from .queries import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "chat_windows_queries", "filter_audit_queries", "fingerprints_queries", "html_text_queries",
    "lm_scores_queries", "metric_tree_queries", "mixing_queries", "near_dedup_queries", "period_runs_queries", "pieces_queries",
    "pii_queries", "quality_queries", "token_files_queries",
]
