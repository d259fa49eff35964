from canton.functions.keys import (
    commune_id, composite_key, election_label, insee_commune_id, numbered_id,
)
from canton.functions.numbers import (
    count_or_fail, double_columns, half_even, per_mille, pct, plain_number, ratio, to_double, to_long,
    truncated, whole,
)
from canton.functions.text import (
    code_text, contains_any, decimal_point, drop_decimal_suffix, lstrip_zeros,
    slugify, strip, zfill,
)
from canton.functions.times import iso_text, timestamp_or_null, year_of
from canton.functions.vectors import above_threshold, dot, sigmoid, weighted_sum

__all__ = [
    "above_threshold", "code_text", "commune_id", "composite_key",
    "contains_any", "count_or_fail", "decimal_point", "dot", "double_columns",
    "drop_decimal_suffix", "election_label", "half_even", "insee_commune_id", "iso_text",
    "lstrip_zeros", "numbered_id", "pct", "per_mille", "plain_number", "ratio", "sigmoid",
    "slugify", "strip", "timestamp_or_null", "to_double", "to_long",
    "truncated", "weighted_sum", "whole", "year_of", "zfill",
]
