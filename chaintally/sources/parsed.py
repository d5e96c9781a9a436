"""Parsed (columnar) form of the transaction and block exports.

``parsed_transactions(lines)`` splits each line once, parses each needed
field once, and keeps, per line, the parsed values the questions use plus
the outcome of every rule as a boolean ``ok_*`` column (a value rule's
outcome is that the parsed value is present).  Every question accepts either
raw lines (parsed on the fly, inside the scan stage) or this table.  Written
to Parquet once with ``ingest_parsed``, later questions read only the columns
they need and their rule checks become boolean filters pushed into the
Parquet scan, instead of re-splitting terabytes of text per question.  Lines
that fail a rule keep their text in ``rejected_line``, so the reject lane
survives the ingest.  Both forms give the same answers, line for line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.functions.parse import parse_amount, parse_gas, parse_long
from chaintally.functions.scalar import month_number
from chaintally.functions.whole import parse_whole
from chaintally.operators.validate import (
    field_count,
    integer,
    lenient_count,
    nonempty,
    not_header,
    numeric,
    timestamp,
    whole_wei,
)
from chaintally.schemas import BLOCK_FIELDS, FIELD_INDEX, TRANSACTION_FIELDS
from chaintally.sources.lines import LINE, computed_once, field, scan_lines, with_fields
from chaintally.sources.results import load_result, save_result

TX = FIELD_INDEX["transactions"]
BLK = FIELD_INDEX["blocks"]
REJECTED = "rejected_line"
# Rows of one file of a partitioned ingest.
FILE_ROWS = 5_000_000


def transaction_checks():
    """Every rule any transaction question uses (outcome columns ok_*)."""
    return [
        field_count(15),
        lenient_count(15, TX["to_address"]),
        not_header(TX["hash"], "hash"),
        nonempty(TX["to_address"], "to_address"),
        numeric(TX["value"], "value"),
        whole_wei(TX["value"], "value"),
        numeric(TX["gas"], "gas"),
        numeric(TX["gas_price"], "gas_price"),
        *timestamp(TX["block_timestamp"], "block_timestamp"),
    ]


def block_checks():
    return [
        field_count(19),
        not_header(BLK["number"], "number"),
        nonempty(BLK["miner"], "miner"),
        integer(BLK["size"], "size"),
    ]


def is_parsed(df: DataFrame) -> bool:
    return "ok_arity" in df.columns


# Fields kept as text by an ingest, besides the parsed ones.
TRANSACTION_TEXTS = tuple(n for n in TRANSACTION_FIELDS if n not in ("value", "gas", "gas_price", "block_timestamp"))
BLOCK_TEXTS = tuple(n for n in BLOCK_FIELDS if n not in ("size",))

TRANSACTION_VALUES = {
    **{c: (lambda c=c: field(TX[c])) for c in TRANSACTION_TEXTS},
    "value": lambda: parse_amount(field(TX["value"])),
    "value_wei": lambda: parse_whole(field(TX["value"])),
    "gas": lambda: parse_gas(field(TX["gas"])),
    "gas_price": lambda: parse_amount(field(TX["gas_price"])),
    "block_timestamp": lambda: parse_long(field(TX["block_timestamp"])),
}

BLOCK_VALUES = {
    **{c: (lambda c=c: field(BLK[c])) for c in BLOCK_TEXTS},
    "size": lambda: parse_long(field(BLK["size"])),
}

# Values derived from parsed ones: name -> (source, expression).
DERIVED = {"month_no": ("block_timestamp", lambda: month_number("block_timestamp"))}

# The parsed value a value rule's outcome is read from.
_RULE_VALUE = {"ok_number_value": "value", "ok_integer_value": "value_wei", "ok_number_gas": "gas",
               "ok_number_gas_price": "gas_price", "ok_integer_block_timestamp": "block_timestamp",
               "ok_range_block_timestamp": "block_timestamp", "ok_integer_size": "size"}


def _parse(lines: DataFrame, values: dict, checks, columns) -> DataFrame:
    """Split once, parse each needed field once, then name values and outcomes."""
    rules = {r.outcome: r for r in checks}
    everything = columns is None
    if everything:
        columns = [*values, *(d for d, (source, _) in DERIVED.items() if source in values), *rules]
    wanted = [DERIVED[c][0] if c in DERIVED else _RULE_VALUE.get(c, c) for c in columns]
    once = {n: values[n]().alias(n) for n in wanted if n in values}
    once |= {n: rules[n].column().alias(n) for n in wanted if n in rules}
    line = [F.col(LINE).alias("__line")] if everything else []
    parsed = computed_once(with_fields(lines), *once.values(), *line)
    out = {c: DERIVED[c][1]() if c in DERIVED else F.col(c) if c in once else F.coalesce(rules[c].parsed(), F.lit(False))
           for c in columns}
    kept = [e.alias(c) for c, e in out.items()]
    if everything:
        # lenient arity is a choice of one question, not damage
        fine = [e for c, e in out.items() if c in rules and c not in ("ok_arity_lenient", "ok_header")]
        kept.append(F.when(~_all(fine), F.col("__line")).alias(REJECTED))
    return parsed.select(*kept)


def _all(conditions):
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def parsed_transactions(tx: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Parsed transactions from lines; a parsed table is returned as is.

    ``columns`` limits the projection built for raw lines to the values and
    ``ok_*`` outcomes a question uses (the optimizer would prune the rest
    anyway; building fewer expressions keeps the driver-side cost small).
    """
    if is_parsed(tx):
        return tx
    return _parse(tx, TRANSACTION_VALUES, transaction_checks(), columns)


def parsed_blocks(blocks: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Parsed blocks from lines; a parsed table is returned as is."""
    if is_parsed(blocks):
        return blocks
    return _parse(blocks, BLOCK_VALUES, block_checks(), columns)


def needs(values: list[str], *rule_sets) -> list[str]:
    """The values plus the outcome columns of the given rule sets."""
    out = list(values)
    for rules in rule_sets:
        out += [r.outcome for r in rules if r.outcome not in out]
    return out


def ingest_parsed(parsed: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a parsed table as Parquet (optionally partitioned, e.g. by month_no).

    A partitioned table is dealt by that column first, so a task writes few
    folders; ``rebalance`` splits a large month over several tasks and joins small ones, and
    no file holds more than ``FILE_ROWS`` rows.
    """
    if partition_by:
        dealt = parsed.hint("rebalance", F.col(partition_by))
        dealt.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).partitionBy(partition_by).parquet(path)
    else:
        parsed.write.mode("overwrite").parquet(path)
    count_outcomes(parsed.sparkSession, path)


def outcomes_path(path: str) -> str:
    return f"{path.rstrip('/')}_outcomes"


def count_outcomes(spark: SparkSession, path: str) -> None:
    """Write, next to an ingested table, how many lines of each of its files had each outcome of all rules.

    Only the outcome columns are read.  A quality report for any rule set comes from these
    few rows (``operators.validate.outcome_report``).
    """
    table = spark.read.parquet(path)
    outcomes = [c for c in table.columns if c.startswith("ok_")]
    counts = table.select(F.col("_metadata.file_name").alias("file"), *outcomes).groupBy("file", *outcomes).agg(F.count(F.lit(1)).alias("n"))
    save_result(counts.coalesce(1), outcomes_path(path))


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The outcome counts of an ingested table: file, ok_* columns, n."""
    return load_result(spark, outcomes_path(path))


def ingest_transactions(spark: SparkSession, lines_path, out_path: str,
                        partition_by: str | None = None) -> DataFrame:
    """Parse transaction text once into Parquet; return the Parquet table."""
    ingest_parsed(parsed_transactions(scan_lines(spark, lines_path)), out_path, partition_by)
    return spark.read.parquet(out_path)


def ingest_blocks(spark: SparkSession, lines_path, out_path: str) -> DataFrame:
    ingest_parsed(parsed_blocks(scan_lines(spark, lines_path)), out_path)
    return spark.read.parquet(out_path)
