"""Column functions. All are built from Spark expressions, so they stay inside code generation."""

from leadvault.functions.hashing import hash_diff, hash_key, person_hash, surrogate_key
from leadvault.functions.numeric import all_present, any_positive, band, exact_avg, flag, flag01, ratio, score
from leadvault.functions.text import (
    blank_to_null, clean_lower, clean_upper, digits, first_usable, json_fields, non_blank,
    not_sentinel, strip, tagged_name,
)
from leadvault.functions.times import (
    as_date, as_timestamp, days_between, is_current, is_recent, partition_expr,
)

__all__ = [
    "hash_diff", "hash_key", "person_hash", "surrogate_key",
    "all_present", "any_positive", "band", "exact_avg", "flag", "flag01", "ratio", "score",
    "blank_to_null", "clean_lower", "clean_upper", "digits", "first_usable", "json_fields", "non_blank",
    "not_sentinel", "strip", "tagged_name",
    "as_date", "as_timestamp", "days_between", "is_current", "is_recent", "partition_expr",
]
