"""Total parse functions for text fields.

A text field is checked against a regular expression before it is cast, so
that every engine agrees on what parses: Spark's ``try_cast`` accepts "1d"
as a double and rounds "5.7" to a whole decimal, DuckDB accepts "1_000".
The patterns refuse "nan", "inf", "1_000", "1d" and hex text.  A value that
matches but does not fit the target type (a 78-digit uint256) becomes NULL.
Validity rules are ``parse_*(field) IS NOT NULL``, so such a value lands in
the reject lane; a kept line never carries a NULL where a number is summed.

The published jobs checked numbers with a scripting language's own conversions, which
take more: single underscores between digits, a bare point at either end, infinities and
"nan" in any case.  ``*_compat`` accept what those do (of ASCII digits and white space).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chaintally.schemas import AMOUNT, GAS, MAX_EPOCH, MIN_EPOCH, WEI

# Accepted number and integer text (leading/trailing blanks ok).
NUMBER_PATTERN = r"^\s*[+-]?\d+(\.\d+)?([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
# Whole numbers of up to 19 digits, as many as a bigint has, after leading zeros.
LONG_PATTERN = r"^\s*[+-]?0*\d{1,19}\s*$"
# The same for the published jobs' conversions.
_DIGITS = r"\d(_?\d)*"
NUMBER_COMPAT = rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*$"
INTEGER_COMPAT = rf"^\s*[+-]?{_DIGITS}\s*$"
INFINITY_COMPAT = r"^\s*[+-]?(?i:inf|infinity)\s*$"
NAN_COMPAT = r"^\s*[+-]?(?i:nan)\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_number(c) -> Column:
    """True when the text is a decimal number; NULL text is False."""
    return F.coalesce(_col(c).rlike(NUMBER_PATTERN), F.lit(False))


def is_integer(c) -> Column:
    """True when the text is a whole number; NULL text is False."""
    return F.coalesce(_col(c).rlike(INTEGER_PATTERN), F.lit(False))


def is_nonempty(c) -> Column:
    """True when the text has at least one character; NULL is False."""
    return F.coalesce(F.length(_col(c)) > 0, F.lit(False))


def _try_cast(c: Column, type_name: str) -> Column:
    return F.trim(c).try_cast(type_name)


def parse_amount(c) -> Column:
    """Number text to decimal(38,6); NULL unless ``is_number`` and it fits."""
    c = _col(c)
    return F.when(is_number(c), _try_cast(c, AMOUNT.simpleString()))


def parse_gas(c) -> Column:
    """Number text to decimal(18,6); NULL unless ``is_number`` and it fits."""
    c = _col(c)
    return F.when(is_number(c), _try_cast(c, GAS.simpleString()))


def parse_wei(c) -> Column:
    """Integer text to exact decimal(38,0); NULL unless ``is_integer`` and it fits."""
    c = _col(c)
    return F.when(is_integer(c), _try_cast(c, WEI.simpleString()))


def parse_long(c) -> Column:
    """Integer text to bigint; NULL unless ``is_integer`` or on overflow."""
    c = _col(c)
    # a cast that overflows raises and catches an error, so no number too long for the type gets there
    return F.when(c.rlike(LONG_PATTERN), _try_cast(c, "bigint"))


def parse_double(c) -> Column:
    """Number text to double; NULL unless ``is_number``."""
    c = _col(c)
    return F.when(is_number(c), _try_cast(c, "double"))


def parse_double_compat(c) -> Column:
    """Text to double as the published jobs converted it, NaN and infinities included; NULL for what they refused."""
    c = _col(c)
    infinity = F.when(c.contains("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(c.rlike(NUMBER_COMPAT), F.regexp_replace(c, r"[\s_]", "").try_cast("double"))
             .when(c.rlike(INFINITY_COMPAT), infinity)
             .when(c.rlike(NAN_COMPAT), F.lit(float("nan"))))


def parse_long_compat(c) -> Column:
    """Whole-number text to bigint as the published jobs converted it; NULL for what they refused or on overflow."""
    c = _col(c)
    return F.when(c.rlike(INTEGER_COMPAT), F.regexp_replace(c, r"[\s_]", "").try_cast("bigint"))


def in_calendar(epoch_seconds) -> Column:
    """True for seconds whose UTC date has a year from 1 to 9999; NULL is False."""
    return F.coalesce(_col(epoch_seconds).between(MIN_EPOCH, MAX_EPOCH), F.lit(False))


def parse_time(c) -> Column:
    """Integer text to epoch seconds; NULL outside the years 1 to 9999."""
    seconds = parse_long(c)
    return F.when(in_calendar(seconds), seconds)
