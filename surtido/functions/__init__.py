"""Column functions: every one takes and returns a Column."""

from surtido.functions.dates import (
    month_start, months_to_end_of_next_year, parse_timestamp,
)
from surtido.functions.hashes import row_hash
from surtido.functions.numeric import (
    adjusted_skewness, clip, money_round, nan_to_null, r2_score, round_half_even,
)
from surtido.functions.text import is_cancelled, strip_upper, with_missing_as_null

__all__ = [
    "adjusted_skewness", "clip", "is_cancelled", "money_round", "month_start",
    "months_to_end_of_next_year", "nan_to_null", "parse_timestamp", "r2_score",
    "round_half_even", "row_hash", "strip_upper", "with_missing_as_null",
]
