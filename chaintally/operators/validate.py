"""Line validation: rule tables, reject reasons and the quality report.

A rule is a named, total predicate over the split ``fields`` of a line: it
never raises, a missing field simply fails it.  A rule set is checked in
order and the first failing rule names the ``reject_reason`` (NULL for a
kept line), so the kept rows and the reject lane come from the same scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chaintally.functions.parse import (
    in_calendar,
    is_nonempty,
    parse_amount,
    parse_double_compat,
    parse_gas,
    parse_long,
    parse_long_compat,
    parse_time,
)
from chaintally.functions.whole import parse_whole
from chaintally.schemas import FIELD_INDEX
from chaintally.sources.lines import arity, field

REASON = "reject_reason"
OK = "ok"


@dataclass(frozen=True)
class Rule:
    """A named line check; ``check()`` builds a boolean Column (True = keep).

    ``key`` names the column that holds the outcome in a parsed (ingested)
    table; where the frame has that column, the stored outcome is used
    instead of re-checking the text, so the check becomes a pushed-down
    boolean filter on a Parquet scan.  ``parsed`` builds the same outcome
    from the parsed value columns, so a field is parsed once for both.
    """

    reason: str
    check: Callable[[], Column]
    key: str = ""
    parsed: Callable[[], Column] | None = None

    @property
    def outcome(self) -> str:
        return self.key or "ok_" + self.reason.replace(":", "_")

    def column(self, df: DataFrame | None = None) -> Column:
        if df is not None and self.outcome in df.columns:
            return F.col(self.outcome)
        return F.coalesce(self.check(), F.lit(False))


# --- single predicates ------------------------------------------------------


def field_count(n: int) -> Rule:
    """Exactly ``n`` fields (trailing empty fields count)."""
    return Rule("arity", lambda: arity() == n)


def nonempty(i: int, name: str) -> Rule:
    return Rule(f"empty:{name}", lambda: is_nonempty(field(i)))


def _present(reason: str, i: int, name: str, parse: Callable[[Column], Column], value: str = "") -> Rule:
    """Valid is what parses: the parsed value is present, so a number that
    does not fit its type is rejected like one that is no number."""
    return Rule(f"{reason}:{name}", lambda: parse(field(i)).isNotNull(),
                parsed=lambda: F.col(value or name).isNotNull())


def numeric(i: int, name: str) -> Rule:
    """A number that fits decimal(38,6) (gas: decimal(18,6))."""
    return _present("number", i, name, parse_gas if name == "gas" else parse_amount)


def integer(i: int, name: str) -> Rule:
    """A whole number that fits a bigint."""
    return _present("integer", i, name, parse_long)


def numeric_compat(i: int, name: str) -> Rule:
    """A number as the published jobs accepted it: also "1_000", ".5", "5.", infinities and "nan"."""
    return Rule(f"number:{name}", lambda: parse_double_compat(field(i)).isNotNull(), key=f"ok_number_{name}_compat")


def integer_compat(i: int, name: str) -> Rule:
    """A whole number that fits a bigint, as the published jobs accepted it: also "1_000"."""
    return Rule(f"integer:{name}", lambda: parse_long_compat(field(i)).isNotNull(), key=f"ok_integer_{name}_compat")


def whole_wei(i: int, name: str) -> Rule:
    """A whole number of any length."""
    return _present("integer", i, name, parse_whole, f"{name}_wei")


def timestamp(i: int, name: str) -> list[Rule]:
    """Epoch seconds: a bigint, and a date of the years 1 to 9999."""
    return [integer(i, name),
            Rule(f"range:{name}", lambda: parse_time(field(i)).isNotNull(), parsed=lambda: in_calendar(name))]


def not_header(i: int, literal: str) -> Rule:
    """Drop a header line recognised by the literal text of field ``i``."""
    return Rule("header", lambda: F.coalesce(field(i) != F.lit(literal), F.lit(True)))


def lenient_count(n: int, i: int) -> Rule:
    """Reject only when the count is wrong *and* field ``i`` is empty.

    This is the rule a published job applied by writing ``and`` where ``or``
    was meant.  A short line with no field ``i`` is rejected (the original
    raised there).
    """
    return Rule("arity", lambda: (arity() == n) | ((arity() > i) & is_nonempty(field(i))),
                key="ok_arity_lenient")


# --- rule sets (one per published job) -------------------------------------

_TX = FIELD_INDEX["transactions"]
_BLK = FIELD_INDEX["blocks"]
_CON = FIELD_INDEX["contracts"]


def _tx(kind: Callable, name: str):
    return kind(_TX[name], name)


def _blk(kind: Callable, name: str):
    return kind(_BLK[name], name)


def tx_value_time() -> list[Rule]:
    """Monthly activity: 15 fields, value is a number, timestamp an integer."""
    return [field_count(15), _tx(numeric, "value"), *_tx(timestamp, "block_timestamp")]


def tx_value_time_compat() -> list[Rule]:
    """Monthly activity with the published jobs' own conversions (a time outside the calendar is still refused)."""
    i = _TX["block_timestamp"]
    return [field_count(15), _tx(numeric_compat, "value"), integer_compat(i, "block_timestamp"),
            Rule("range:block_timestamp", lambda: in_calendar(parse_long_compat(field(i))), key="ok_range_block_timestamp_compat")]


def tx_recipient(exact: bool = False) -> list[Rule]:
    """Recipient totals: 15 fields, recipient present, value a number.

    ``exact=True`` requires whole-number text, as exact wei sums need.
    """
    value = _tx(whole_wei if exact else numeric, "value")
    return [field_count(15), _tx(nonempty, "to_address"), value]


def tx_recipient_time() -> list[Rule]:
    """Scam series: recipient present, whole-number value, integer time."""
    return tx_recipient(exact=True) + _tx(timestamp, "block_timestamp")


def tx_gas() -> list[Rule]:
    """Monthly gas: 15 fields, gas and gas price numbers, integer time."""
    return [field_count(15), _tx(numeric, "gas"), _tx(numeric, "gas_price"),
            *_tx(timestamp, "block_timestamp")]


def tx_gas_only(lenient: bool = False) -> list[Rule]:
    """Mean gas over all transactions; ``lenient`` reproduces the published
    count (wrong-arity lines with a recipient are kept)."""
    count = lenient_count(15, _TX["to_address"]) if lenient else field_count(15)
    return [count, _tx(numeric, "gas")]


def contract_rules() -> list[Rule]:
    return [field_count(6), nonempty(_CON["address"], "address"),
            not_header(_CON["address"], "address")]


def block_miner() -> list[Rule]:
    return [field_count(19), _blk(nonempty, "miner"), _blk(integer, "size")]


def block_any() -> list[Rule]:
    return [field_count(19), not_header(_BLK["number"], "number")]


RULE_SETS: dict[str, Callable[[], list[Rule]]] = {
    "tx_value_time": tx_value_time,
    "tx_value_time_compat": tx_value_time_compat,
    "tx_recipient": tx_recipient,
    "tx_recipient_exact": lambda: tx_recipient(exact=True),
    "tx_recipient_time": tx_recipient_time,
    "tx_gas": tx_gas,
    "tx_gas_only": tx_gas_only,
    "tx_gas_lenient": lambda: tx_gas_only(lenient=True),
    "contract": contract_rules,
    "block_miner": block_miner,
    "block_any": block_any,
}


# --- applying rules ----------------------------------------------------------


def passes(rules: Sequence[Rule], df: DataFrame | None = None) -> Column:
    """One boolean: every rule holds."""
    return reduce(lambda a, b: a & b, [r.column(df) for r in rules])


def reject_reason(rules: Sequence[Rule], df: DataFrame | None = None) -> Column:
    """Reason of the first failing rule, NULL when all hold."""
    expr = None
    for r in rules:
        cond = ~r.column(df)
        expr = F.when(cond, F.lit(r.reason)) if expr is None else expr.when(cond, F.lit(r.reason))
    return expr


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Only the lines every rule accepts."""
    return df.where(passes(rules, df))


def reason_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Lines per outcome: ``reason`` is "ok" for kept lines, else the reason."""
    return (df.select(F.coalesce(reject_reason(rules, df), F.lit(OK)).alias("reason"))
              .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Data-quality report in one pass: per outcome, plus lines/kept/dropped.

    The per-reason counts are a partial+final aggregate over the scan; the
    totals are a window over that result, which has one row per rule at
    most, so the single window partition stays tiny.
    """
    return _with_totals(reason_counts(df, rules))


def outcome_report(outcomes: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The quality report from counts per outcome of all rules (``ok_*`` columns and ``n``), as an ingest writes them.

    Nothing but the counts is read: the reason of a row of counts is that of each line it counts.
    """
    reason = F.coalesce(reject_reason(rules, outcomes), F.lit(OK)).alias("reason")
    return _with_totals(outcomes.select(reason, "n").groupBy("reason").agg(F.sum("n").alias("n")))


def _with_totals(counts: DataFrame) -> DataFrame:
    """Counts per reason with the lines in all, kept and dropped."""
    everything = Window.partitionBy()
    kept = F.sum(F.when(F.col("reason") == OK, F.col("n")).otherwise(F.lit(0))).over(everything)
    lines = F.sum("n").over(everything)
    return (counts
            .select("reason", "n", lines.alias("lines"), kept.alias("kept"))
            .withColumn("dropped", F.col("lines") - F.col("kept")))


def observe_quality(df: DataFrame, rules: Sequence[Rule], name: str = "quality"):
    """Count lines, kept lines and each reject reason without a second scan.

    Returns ``(observed, observation)``: ``observed`` has the rows of ``df``;
    the counts (``lines``, ``ok`` and one per reason) are in ``observation.get``
    after the first action on it.
    """
    obs = Observation(name)
    outcome = F.coalesce(reject_reason(rules, df), F.lit(OK))
    names = [OK, *dict.fromkeys(r.reason for r in rules)]
    observed = df.observe(obs, F.count(F.lit(1)).alias("lines"),
                          *[F.count_if(outcome == n).alias(n) for n in names])
    return observed, obs


def observed_report(spark: SparkSession, obs: Observation) -> DataFrame:
    """The quality report of an observation: one row per outcome that occurred."""
    counts = dict(obs.get)
    lines = counts.pop("lines")
    rows = [(reason, n, lines, counts[OK], lines - counts[OK]) for reason, n in counts.items() if n]
    return spark.createDataFrame(rows, "reason string, n long, lines long, kept long, dropped long")
