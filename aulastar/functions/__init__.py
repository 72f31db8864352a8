"""Column-level building blocks (JVM-side expressions only, no Python UDFs)."""

from aulastar.functions.hashing import row_hash
from aulastar.functions.numeric import (
    decade, exact_avg, exact_ratio, guarded_ratio, is_leap_year, pct_change, ratio_of_sums, safe_int,
)
from aulastar.functions.predicates import (
    bool_label, canonicalize, default_if_null, in_values, matches_place, outlier_category, quality_flag,
    trend_label,
)
from aulastar.functions.text import (
    collapse_ws, is_digits, normalize_header, null_tokens, snake_case,
    strip_accents, trim_unicode, truncate,
)

__all__ = [
    "row_hash", "decade", "exact_avg", "exact_ratio", "guarded_ratio", "is_leap_year", "pct_change",
    "ratio_of_sums", "safe_int", "bool_label", "canonicalize", "default_if_null", "in_values", "matches_place",
    "outlier_category", "quality_flag", "trend_label", "collapse_ws", "is_digits",
    "normalize_header", "null_tokens", "snake_case", "strip_accents", "trim_unicode",
    "truncate",
]
