"""Scalar functions over columns and over landing paths."""

from loadledger.functions.columns import (
    content_fingerprint,
    exact_sum,
    first_present,
    is_close,
    is_newer,
    normalize_date,
    normalize_hour,
    parse_period,
    period_date,
    safe_numeric,
)
from loadledger.functions.paths import (
    canonical_name,
    is_landing_path,
    landing_folder,
    landing_pattern,
    path_date,
    path_respondent,
    path_revision_id,
    path_version,
    revision_name,
    source_of,
)

__all__ = [
    "canonical_name",
    "content_fingerprint",
    "exact_sum",
    "first_present",
    "is_close",
    "is_landing_path",
    "is_newer",
    "landing_folder",
    "landing_pattern",
    "normalize_date",
    "normalize_hour",
    "parse_period",
    "path_date",
    "path_respondent",
    "path_revision_id",
    "path_version",
    "period_date",
    "revision_name",
    "safe_numeric",
    "source_of",
]
