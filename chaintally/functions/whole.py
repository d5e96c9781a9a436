"""Whole numbers of any length as text, cut into decimal limbs to be summed.

A ledger amount is a uint256: 78 digits, twice what a decimal column holds, and
sums are longer still.  Such a number is kept as canonical text (no blanks, no
plus, no leading zeros, no "-0").  For sums the text is cut into limbs of
``LIMB`` digits, lowest first; limb sums are plain decimal sums, and the carry
is done once per total (``digits_of``).  ``whole_order`` orders the texts as numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chaintally.functions.parse import is_integer

# Digits of a limb: it fits a decimal of 18 digits, which Spark keeps as a long.
LIMB = 18
PART = f"decimal({LIMB},0)"
# Sums of limbs: room for 10**20 addends.
SUM = "decimal(38,0)"
# Column metadata of whole-number text: sinks write it bare, as a number.
WHOLE = {"number": "whole"}
# Fixed value: the parts of whole-number text that are kept, sign and digits.
_CANONICAL = r"^\s*\+?(-?)0*(\d+)\s*$"
# Fixed value: canonical text that is not negative.
_PLAIN = r"\A(0|[1-9][0-9]*)\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_whole(c) -> Column:
    """Integer text of any length as canonical text; NULL unless ``is_integer``."""
    c = _col(c)
    kept = F.regexp_replace(c, _CANONICAL, "$1$2")
    # most numbers stand as they are kept, and need no second pattern
    return F.when(c.rlike(_PLAIN), c).when(is_integer(c), F.when(kept == "-0", F.lit("0")).otherwise(kept))


def limbs(whole) -> Column:
    """Limbs of canonical text, lowest first, each with the number's sign."""
    whole = _col(whole)
    negative = whole.startswith("-")
    digits = F.when(negative, F.substring(whole, F.lit(2), F.length(whole))).otherwise(whole)
    size = F.length(digits)
    sign = F.when(negative, F.lit(-1)).otherwise(F.lit(1)).cast(PART)

    def limb(i: Column) -> Column:
        end = size - i * LIMB
        start = F.greatest(end - LIMB, F.lit(0))
        return (F.substring(digits, start + 1, end - start).cast(PART) * sign).cast(PART)

    # a number of one limb needs no loop
    return F.when(size <= LIMB, F.array(whole.cast(PART))).otherwise(
        F.transform(F.sequence(F.lit(0), F.ceil(size / LIMB).cast("int") - 1), limb))


def _carried(sums: Column) -> Column:
    """Canonical text of limb sums (lowest first) whose total is not negative, else NULL."""
    base = F.lit(10 ** LIMB).cast(SUM)
    start = F.struct(F.lit(0).cast(SUM).alias("carry"), F.lit("").alias("text"))

    def step(state: Column, s: Column) -> Column:
        total = (s.cast(SUM) + state["carry"]).cast(SUM)
        rest = F.pmod(total, base).cast(SUM)
        return F.struct(((total - rest) / base).cast(SUM).alias("carry"),
                        F.concat(F.lpad(rest.cast("string"), LIMB, "0"), state["text"]).alias("text"))

    end = F.aggregate(sums, start, step)
    whole = F.ltrim(F.concat(end["carry"].cast("string"), end["text"]), F.lit("0"))
    return F.when(end["carry"] >= 0, F.when(whole == "", F.lit("0")).otherwise(whole))


def digits_of(sums: Column) -> Column:
    """Canonical text of the number whose limbs sum up to ``sums`` (decimals, lowest limb first)."""
    return F.coalesce(_carried(sums), F.concat(F.lit("-"), _carried(F.transform(sums, lambda s: -s))))


def whole_order(whole, falling: bool = False) -> Column:
    """A key that orders canonical texts as numbers: signed length, then digits (turned round below zero)."""
    whole = _col(whole)
    turned, size = F.translate(whole, "0123456789", "9876543210"), F.length(whole)
    below = whole.startswith("-") if not falling else ~whole.startswith("-")
    return F.when(whole.isNotNull(), F.struct(F.when(below, -size).otherwise(size).alias("size"),
                                              F.when(below, turned).otherwise(whole).alias("digits")))


def as_whole(whole: Column, name: str) -> Column:
    """The column under a name, marked as whole-number text."""
    return whole.alias(name, metadata=WHOLE)
