"""Typed sources for the three CSV tables of the ledger export.

Each reader scans the text lines once, splits them (``quoted`` by default,
``naive`` to reproduce the published field counting), checks every field
against its type and projects named, typed columns.  Lines that fail go to
a reject lane with the reason instead of failing the job; nothing relies on
the CSV reader's own casting, which would silently round "5.7" to 6.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.functions.parse import in_calendar, parse_long, parse_wei
from chaintally.functions.whole import as_whole, parse_whole
from chaintally.operators.validate import REASON, Rule, passes, reject_reason
from chaintally.schemas import BLOCK_FIELDS, CONTRACT_FIELDS, TRANSACTION_FIELDS
from chaintally.sources.lines import LINE, arity, computed_once, field, scan_lines, with_fields


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # text | long | time | wei | int | bool | list ; "?" suffix = may be empty

    @property
    def optional(self) -> bool:
        return self.kind.endswith("?")

    @property
    def base(self) -> str:
        return self.kind.rstrip("?")


# Kind of each field that is not plain text, by name ("?" = may be empty).
KINDS = {
    "nonce": "long", "block_number": "long", "transaction_index": "long", "to_address": "text?", "value": "wei",
    "gas": "long", "gas_price": "wei", "input": "text?", "block_timestamp": "time", "max_fee_per_gas": "wei?",
    "max_priority_fee_per_gas": "wei?", "transaction_type": "int?",
}
BLOCK_KINDS = {
    "number": "long", "nonce": "text?", "sha3_uncles": "text?", "logs_bloom": "text?", "transactions_root": "text?",
    "state_root": "text?", "receipts_root": "text?", "miner": "text?", "difficulty": "wei", "total_difficulty": "wei",
    "size": "long", "extra_data": "text?", "gas_limit": "long", "gas_used": "long", "timestamp": "time",
    "transaction_count": "long", "base_fee_per_gas": "wei?",
}
CONTRACT_KINDS = {
    "bytecode": "text?", "function_sighashes": "list?", "is_erc20": "bool?", "is_erc721": "bool?", "block_number": "long?",
}


def _layout(names: tuple[str, ...], kinds: dict[str, str]) -> tuple[Field, ...]:
    return tuple(Field(n, kinds.get(n, "text")) for n in names)


LAYOUTS = {
    "transactions": _layout(TRANSACTION_FIELDS, KINDS),
    "blocks": _layout(BLOCK_FIELDS, BLOCK_KINDS),
    "contracts": _layout(CONTRACT_FIELDS, CONTRACT_KINDS),
}

_BOOL_TEXT = ("true", "false")


def _value(f: Field, c: Column, wide: bool) -> Column:
    """The typed value of a field's text, NULL where it has none."""
    if f.base == "text":
        return F.when(F.length(c) > 0, c)
    if f.base in ("long", "time"):
        return parse_long(c)
    if f.base == "int":
        return parse_long(c).try_cast("int")
    if f.base == "wei":
        return parse_whole(c) if wide else parse_wei(c)
    if f.base == "bool":
        low = F.lower(F.trim(c))
        return F.when(low.isin(*_BOOL_TEXT), low == "true")
    # list: comma separated text inside one (unquoted) field
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ",", -1))


def _sound(f: Field, value: Column, size: Column) -> Column:
    """Whether a field is as its kind says, from its parsed value and its length (NULL: the line is too short).

    A number that does not fit its type has no value, so it is rejected and not NULL.
    """
    if f.base == "list":
        return F.lit(True)
    if f.base == "time":
        return in_calendar(value)
    if not f.optional:
        return value.isNotNull()
    return size.isNotNull() if f.base == "text" else value.isNotNull() | F.coalesce(size == 0, F.lit(False))


def layout_rules(layout: tuple[Field, ...]) -> list[Rule]:
    """Field count, header line, then one rule per field, over the columns of ``_parsed_once``."""
    rules = [Rule("arity", lambda: F.col("__arity") == len(layout)), Rule("header", lambda: F.coalesce(F.col("__first") != layout[0].name, F.lit(True)))]
    for i, f in enumerate(layout):
        rules.append(Rule(f"{f.base}:{f.name}", lambda i=i, f=f: _sound(f, F.col(f"__v{i}"), F.col(f"__n{i}"))))
    return rules


def _parsed_once(lines: DataFrame, layout: tuple[Field, ...], csv_mode: str, wide: bool) -> DataFrame:
    """Each field parsed one time: its value (``__v``) and length (``__n``), with the arity, the first field and the line."""
    values = [_value(f, field(i), wide).alias(f"__v{i}") for i, f in enumerate(layout)]
    sizes = [F.length(field(i)).alias(f"__n{i}") for i, f in enumerate(layout) if f.optional]
    return computed_once(with_fields(lines, csv_mode), *values, *sizes, arity().alias("__arity"), field(0).alias("__first"), F.col(LINE))


def parse_export(lines: DataFrame, table: str, csv_mode: str = "quoted",
                 with_rejects: bool = False, wide: bool = False) -> DataFrame:
    """Typed rows of an export table from its text lines.

    ``with_rejects=False`` keeps valid rows only; ``True`` keeps every line
    with ``reject_reason`` (NULL when valid) and the raw ``value`` text.
    Amounts are decimal(38,0), and longer ones are rejected; ``wide=True`` gives
    them as whole-number text of any length (``functions.whole``).

    Every field's pattern runs once a line: the rules read the parsed values.
    """
    layout = LAYOUTS[table]
    rules = layout_rules(layout)
    parsed = _parsed_once(lines, layout, csv_mode, wide)

    def named(i: int, f: Field) -> Column:
        return as_whole(F.col(f"__v{i}"), f.name) if wide and f.base == "wei" else F.col(f"__v{i}").alias(f.name)

    typed = [named(i, f) for i, f in enumerate(layout)]
    if with_rejects:
        return parsed.select(*typed, reject_reason(rules).alias(REASON), F.col(LINE))
    return parsed.where(passes(rules)).select(*typed)


def scan_transactions(spark: SparkSession, path, csv_mode: str = "quoted",
                 with_rejects: bool = False, wide: bool = False) -> DataFrame:
    return parse_export(scan_lines(spark, path), "transactions", csv_mode, with_rejects, wide)


def scan_blocks(spark: SparkSession, path, csv_mode: str = "quoted",
                 with_rejects: bool = False, wide: bool = False) -> DataFrame:
    return parse_export(scan_lines(spark, path), "blocks", csv_mode, with_rejects, wide)


def scan_contracts(spark: SparkSession, path, csv_mode: str = "quoted",
                 with_rejects: bool = False, wide: bool = False) -> DataFrame:
    return parse_export(scan_lines(spark, path), "contracts", csv_mode, with_rejects, wide)
