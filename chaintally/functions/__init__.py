"""Column functions: parsing, month keys, hex sizes, ids and units.

Every function takes and returns a ``Column`` built from built-in Spark
expressions, so it runs inside whole-stage code generation.
"""

from chaintally.functions.parse import (
    INTEGER_PATTERN,
    NUMBER_PATTERN,
    is_integer,
    is_nonempty,
    is_number,
    parse_amount,
    parse_double,
    parse_double_compat,
    parse_gas,
    parse_long,
    parse_long_compat,
    parse_time,
    parse_wei,
)
from chaintally.functions.scalar import (
    bits_to_gb,
    composite_id,
    hex_bits,
    mean_of,
    month_key,
    month_label,
    month_number,
    trim_chars,
)
from chaintally.functions.whole import digits_of, limbs, parse_whole, whole_order

__all__ = [
    "INTEGER_PATTERN", "NUMBER_PATTERN", "is_integer", "is_nonempty",
    "is_number", "parse_amount", "parse_double", "parse_double_compat", "parse_gas", "parse_long", "parse_long_compat", "parse_time",
    "parse_wei", "parse_whole", "digits_of", "limbs", "whole_order", "bits_to_gb", "composite_id", "hex_bits", "mean_of", "month_key",
    "month_label", "month_number", "trim_chars",
]
