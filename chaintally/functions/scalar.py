"""Scalar column functions of the monthly series and size reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chaintally.functions.parse import in_calendar
from chaintally.schemas import BITS_PER_HEX_DIGIT, GB_PER_BIT, HEX_PREFIX_LENGTH

SECONDS_PER_DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_number(epoch_seconds) -> Column:
    """Months since year 0 of the UTC month holding ``epoch_seconds`` (an integer).

    Goes through the day number, so the result does not depend on the
    session time zone; NULL outside the years 1 to 9999.  Grouping by it and
    labelling the few result rows (``month_label``) saves a text per input row.
    """
    seconds = _col(epoch_seconds)
    day = F.date_from_unix_date(F.floor(F.when(in_calendar(seconds), seconds) / SECONDS_PER_DAY).cast("int"))
    return F.year(day) * 12 + F.month(day) - 1


def month_label(number) -> Column:
    """Label "YYYY/MM" of a month number."""
    number = _col(number)
    return F.concat_ws("/", F.lpad(F.floor(number / 12).cast("string"), 4, "0"),
                       F.lpad((number % 12 + 1).cast("string"), 2, "0"))


def month_key(epoch_seconds) -> Column:
    """Epoch seconds to the UTC month label "YYYY/MM" (1438922527 -> 2015/08); NULL outside the years 1 to 9999."""
    number = month_number(epoch_seconds)
    return F.when(number.isNotNull(), month_label(number))


def hex_bits(c) -> Column:
    """Bits a hex text stores: (characters - 2) * 4.

    "0x" gives 0; an empty or NULL field gives -8, as the character count
    of an empty field does.
    """
    n = F.length(F.coalesce(_col(c), F.lit("")))
    return ((n - HEX_PREFIX_LENGTH) * BITS_PER_HEX_DIGIT).cast("bigint")


def bits_to_gb(bits) -> Column:
    return _col(bits).cast("double") * F.lit(GB_PER_BIT)


def composite_id(scam_id, category) -> Column:
    """Scam id and category joined as "<id>_<category>" (e.g. 5622_Scamming); NULL if either is missing."""
    return F.concat(_col(scam_id), F.lit("_"), _col(category))


def trim_chars(c, chars: str = ' []"') -> Column:
    """Strip every character of ``chars`` from both ends of the text."""
    return F.btrim(_col(c), F.lit(chars))


def mean_of(total, count) -> Column:
    """Mean as double from an exact sum and a count (NULL for no rows)."""
    return F.when(_col(count) > 0, _col(total).cast("double") / _col(count).cast("double"))
