from .aggregates import mean_of, regression_scores, row_digest, digest_sum
from .columns import (
    band,
    blank,
    calendar_parts,
    cap_at,
    clip_low,
    number_or_null,
    percent_of,
    row_mean,
    share_of,
    to_whole,
)
from .profiles import fill_profile

__all__ = [
    "band", "blank", "calendar_parts", "cap_at", "clip_low", "digest_sum", "fill_profile", "mean_of",
    "number_or_null", "percent_of", "regression_scores", "row_digest", "row_mean", "share_of", "to_whole",
]
