"""Command-line jobs: one per published question, from export files to results.

    spark-submit --py-files chaintally.zip chaintally/jobs.py monthly-value --transactions s3a://bucket/transactions.csv \\
        --out s3a://bucket/results/monthly_value

Inputs are the export files (text lines; ``--parsed`` when the transaction or
block path holds the Parquet form written by ``ingest``).  Results are written
by the executors with the DataFrame writer (JSON lines by default); a top-k
question also writes the published ``[[key, value], ...]`` document with
``--pairs``.  ``--quality`` adds a data-quality report per input (lines / kept
/ dropped per reason) next to the result; transactions, blocks and contracts are
counted while the question's own scan reads them.  An option or input that a job
cannot use is an error.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.operators.rank import measure_order
from chaintally.operators.registry import registry_report
from chaintally.operators.validate import (
    block_any,
    block_miner,
    contract_rules,
    observe_quality,
    observed_report,
    tx_gas,
    tx_gas_only,
    tx_recipient,
    tx_recipient_time,
    tx_value_time,
)
from chaintally.plans import ledger as L
from chaintally.sources.lines import scan_lines
from chaintally.sources.parsed import ingest_blocks, ingest_transactions, parsed_blocks, parsed_transactions
from chaintally.sources.registry import scan_registry
from chaintally.sources.results import load_result, save_result, save_top_pairs


@dataclass(frozen=True)
class Job:
    """A question: how to build it from its inputs, its rules per input, and its top-k key and value."""

    build: Callable
    rules: dict[str, Callable]
    pair: tuple[str, str] | None = None
    options: tuple[str, ...] = ()


class Inputs:
    """The inputs of one run; with ``quality``, each is observed while it is read."""

    def __init__(self, spark: SparkSession, a, rules: dict[str, Callable]):
        self.spark, self.a, self.rules, self.seen = spark, a, rules, {}

    def _observed(self, name: str, df: DataFrame) -> DataFrame:
        if not self.a.quality or name not in self.rules:
            return df
        df, self.seen[name] = observe_quality(df, self.rules[name](), f"quality_{name}")
        return df

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path) if self.a.parsed else scan_lines(self.spark, path)

    def transactions(self) -> DataFrame:
        lines = self._read(self.a.transactions)
        return self._observed("transactions", parsed_transactions(lines)) if self.a.quality else lines

    def blocks(self) -> DataFrame:
        lines = self._read(self.a.blocks)
        return self._observed("blocks", parsed_blocks(lines)) if self.a.quality else lines

    def contracts(self) -> DataFrame:
        """Addresses of valid contract lines."""
        return L.contract_addresses(scan_lines(self.spark, self.a.contracts), self.a.csv_mode,
                                    lambda df: self._observed("contracts", df))

    def registry(self) -> DataFrame:
        return scan_registry(self.spark, self.a.registry)


def _only(i: Inputs) -> DataFrame | None:
    return i.contracts() if i.a.contracts_only else None


JOB_TABLE: dict[str, Job] = {
    "monthly-value": Job(lambda i: L.monthly_value(i.transactions()), {"transactions": tx_value_time}),
    "top-contracts": Job(lambda i: L.top_contracts(i.transactions(), i.contracts(), i.a.k, bag=i.a.bag),
                         {"transactions": tx_recipient, "contracts": contract_rules}, ("address", "total_value"),
                         ("k", "csv_mode", "bag")),
    "top-miners": Job(lambda i: L.top_miners(i.blocks(), i.a.k), {"blocks": block_miner}, ("miner", "total_size"), ("k",)),
    "overhead": Job(lambda i: L.overhead_report(L.block_hex_frame(i.blocks()), L.HEX_BLOCK_FIELDS), {"blocks": block_any}),
    "monthly-gas": Job(lambda i: L.monthly_gas(i.transactions(), _only(i)),
                       {"transactions": tx_gas, "contracts": contract_rules}, None, ("csv_mode", "contracts_only")),
    "mean-gas": Job(lambda i: L.global_mean_gas(i.transactions(), i.a.lenient, _only(i)),
                    {"transactions": tx_gas_only, "contracts": contract_rules}, None, ("csv_mode", "lenient", "contracts_only")),
    "gas-vs-mean": Job(lambda i: L.above_below_mean(i.transactions(), i.contracts(), i.a.k, lenient=i.a.lenient),
                       {"transactions": tx_gas_only, "contracts": contract_rules}, ("address", "avg_gas"),
                       ("k", "csv_mode", "lenient")),
    "top-scams": Job(lambda i: L.top_scams(i.transactions(), i.registry(), i.a.k, not i.a.bag),
                     {"transactions": lambda: tx_recipient(exact=True), "registry": list}, ("scam_id", "total_value"), ("k", "bag")),
    "scam-monthly": Job(lambda i: L.scam_monthly(i.transactions(), i.registry(), not i.a.bag, i.a.categories or None),
                        {"transactions": tx_recipient_time, "registry": list}, None, ("bag", "categories")),
}

JOBS = tuple(JOB_TABLE)


_OPTIONS = {
    "k": ("--k", {"type": int, "default": 10}),
    "csv_mode": ("--csv-mode", {"default": "quoted", "choices": ("quoted", "naive")}),
    "bag": ("--bag", {"action": "store_true", "help": "keep duplicate contract/registry rows (published counting)"}),
    "lenient": ("--lenient", {"action": "store_true", "help": "published field-count rule for the overall gas mean"}),
    "contracts_only": ("--contracts-only", {"action": "store_true", "help": "count transactions to contracts only"}),
    "categories": ("--categories", {"nargs": "*"}),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chaintally.jobs", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)
    for name, job in JOB_TABLE.items():
        j = sub.add_parser(name)
        for source in job.rules:
            optional = source == "contracts" and "contracts_only" in job.options
            j.add_argument(f"--{source}", required=not optional)
        j.add_argument("--out", required=True)
        j.add_argument("--format", default="json", choices=("json", "parquet", "csv"))
        j.add_argument("--quality", action="store_true", help="also write a data-quality report per input")
        j.set_defaults(parsed=False, pairs=False, k=10, csv_mode="quoted", bag=False, lenient=False, contracts_only=False, categories=None)
        if {"transactions", "blocks"} & set(job.rules):
            j.add_argument("--parsed", action="store_true", help="inputs are the ingested Parquet form")
        if job.pair:
            j.add_argument("--pairs", action="store_true", help="also write the [[key, value], ...] document")
        for option in job.options:
            flag, how = _OPTIONS[option]
            j.add_argument(flag, **how)
    ing = sub.add_parser("ingest", help="parse transaction / block text once into Parquet")
    ing.add_argument("--transactions")
    ing.add_argument("--blocks")
    ing.add_argument("--out", required=True)
    ing.add_argument("--partition-by-month", action="store_true")
    return p


def run(spark: SparkSession, argv: list[str]) -> None:
    p = parser()
    a = p.parse_args(argv)
    if a.command == "ingest":
        if not (a.transactions or a.blocks):
            p.error("ingest needs --transactions or --blocks")
        if a.transactions:
            ingest_transactions(spark, a.transactions, f"{a.out}/transactions",
                                "month_no" if a.partition_by_month else None)
        if a.blocks:
            ingest_blocks(spark, a.blocks, f"{a.out}/blocks")
        return
    if a.contracts_only and not a.contracts:
        p.error("--contracts-only needs --contracts")
    job = JOB_TABLE[a.command]
    inputs = Inputs(spark, a, job.rules)
    result = job.build(inputs)
    save_result(result, f"{a.out}/result", fmt=a.format)
    if a.pairs:
        key, value = job.pair
        # read the written result back with its own schema: exact decimals, no recomputation
        saved = load_result(spark, f"{a.out}/result", a.format, result.schema)
        save_top_pairs(saved, f"{a.out}/pairs", key, value, [measure_order(saved, value).desc(), F.col(key)], a.k)
    if a.quality:
        for name, seen in inputs.seen.items():
            save_result(observed_report(spark, seen), f"{a.out}/quality/{name}", fmt=a.format)
        if "registry" in job.rules:
            save_result(registry_report(inputs.registry()), f"{a.out}/quality/registry", fmt=a.format)


def main() -> None:  # pragma: no cover - command-line entry
    import sys

    from chaintally.session import SESSION_DEFAULTS
    builder = SparkSession.builder.appName("chaintally")  # master and resources come from spark-submit
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    run(builder.getOrCreate(), sys.argv[1:])


if __name__ == "__main__":  # pragma: no cover
    main()
