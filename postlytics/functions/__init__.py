"""Column -> Column expressions, all built from Spark's own functions."""

from .counts import DEFAULT_ERROR_VALUES, DEFAULT_SUFFIXES, count_multiplier, parse_count
from .groups import DEFAULT_AGE_BANDS, UNKNOWN_AGE, age_band
from .text import digit_pattern, join_names, without_prefix
from .time import MESSAGE_TS_FORMAT, to_ts, ts_text

__all__ = [
    "DEFAULT_AGE_BANDS", "DEFAULT_ERROR_VALUES", "DEFAULT_SUFFIXES", "MESSAGE_TS_FORMAT",
    "UNKNOWN_AGE", "age_band", "count_multiplier", "digit_pattern", "join_names",
    "parse_count", "to_ts", "ts_text", "without_prefix",
]
