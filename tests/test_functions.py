"""Column functions: parse parity, month keys, hex sizes, ids."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chaintally.functions import (
    composite_id,
    hex_bits,
    is_integer,
    is_number,
    month_key,
    parse_amount,
    parse_double_compat,
    parse_gas,
    parse_long,
    parse_long_compat,
    parse_time,
    parse_wei,
    trim_chars,
)


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,number,integer", [
    (" 5 ", True, True), ("+5", True, True), ("5.7", True, False), ("1e18", True, False),
    ("1_000", False, False), ("nan", False, False), ("inf", False, False), ("1d", False, False),
    ("5f", False, False), ("", False, False), ("value", False, False), ("0x10", False, False),
    (None, False, False),
])
def test_number_and_integer_rules(spark, text, number, integer):
    assert one(spark, is_number, text) is number
    assert one(spark, is_integer, text) is integer


def test_published_conversions(spark):
    """The compat parsers take what the published jobs' own conversions take, and give the same values."""
    texts = ["5", " 5\t", "+5", "-5", "5.7", ".5", "5.", ".", "", " ", "1e18", "1E+2", "1e-2", "1e", "e5", "1_000", "1__0", "_1", "1_", "1_0.0_1", "1_.0",
             "1._0", "1e1_0", "1e_1", "nan", " NaN ", "-nan", "inf", "-Infinity", "+INF", "infinit", "1d", "5f", "0x10", "value", "--5", "+ 5", "1 0",
             "9" * 78, "1e400", "-1e400", "9" * 25, "007", "0_7"]

    def converted(kind, text):
        try:
            return kind(text)
        except ValueError:
            return None

    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, x string").select(
        "i", parse_double_compat("x").alias("double"), parse_long_compat("x").alias("long")).orderBy("i").collect()
    for text, row in zip(texts, rows):
        whole = converted(int, text)
        assert repr(row.double) == repr(converted(float, text)), text
        assert row.long == (whole if whole is not None and abs(whole) < 2 ** 63 else None), text
    assert rows[-1].double is None and rows[-1].long is None


def test_parsers_never_round_or_fail(spark):
    assert one(spark, parse_wei, "5.7") is None            # not rounded to 6
    assert one(spark, parse_amount, "5.7") == Decimal("5.7")
    assert one(spark, parse_amount, "1e18") == Decimal(10 ** 18)
    assert one(spark, parse_wei, "9" * 78) is None          # uint256 beyond 38 digits: reject lane
    assert one(spark, parse_long, "9" * 25) is None         # bigint overflow: NULL, no failure
    assert one(spark, parse_wei, " 16709083588073530571339 ") == Decimal("16709083588073530571339")


@pytest.mark.parametrize("seconds,month", [
    (1438922527, "2015/08"), (1438387199, "2015/07"), (1438387200, "2015/08"), (0, "1970/01"), (-1, "1969/12"),
    (-62135596800, "0001/01"), (253402300799, "9999/12"), (253402300800, None), (-62135596801, None),
    (999999999999999999, None), (1500000000000, None), (None, None),
])
def test_month_key_is_utc(spark, seconds, month):
    assert one(spark, month_key, seconds, "bigint") == month


def test_times_out_of_the_calendar_do_not_parse(spark):
    assert one(spark, parse_time, "1438922527") == 1438922527
    assert [one(spark, parse_time, t) for t in ("9" * 20, "9" * 18, "1500000000000", "x", None)] == [None] * 5


def test_gas_beyond_its_type_does_not_parse(spark):
    assert one(spark, parse_gas, " 21000 ") == 21000 and one(spark, parse_gas, "9" * 40) is None


def test_month_key_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, month_key, 1438387200, "bigint") == "2015/08"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text,bits", [("0x", 0), ("", -8), (None, -8), ("0x" + "0" * 64, 256), ("0x" + "f" * 512, 2048)])
def test_hex_bits(spark, text, bits):
    assert one(spark, hex_bits, text) == bits


def test_trim_and_composite_id(spark):
    assert one(spark, trim_chars, ' ["0xabc"') == "0xabc"
    row = spark.createDataFrame([("5622", "Scamming"), (None, "Phishing")], "i string, c string") \
        .select(composite_id("i", "c").alias("k")).collect()
    assert [r.k for r in row] == ["5622_Scamming", None]
