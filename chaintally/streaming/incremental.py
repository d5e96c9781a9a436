"""Monthly series kept up to date by exact partial sums, one set for each batch of input files.

A store is one Parquet table that only grows.  Adding files reads the new ones alone and
appends, in one committed write, their partial sums and their names: a
file is either counted with its name recorded or not at all, and a file that is named already
adds nothing.  Partial sums are counts, decimals and limbs, which add up in any grouping, so
the answer is that over all files at once.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.functions.scalar import mean_of, month_label
from chaintally.operators.aggregate import limb_sums, sums_to_totals
from chaintally.operators.validate import keep_valid, tx_gas, tx_value_time
from chaintally.plans import ledger
from chaintally.sources.parsed import needs, parsed_transactions


@dataclass(frozen=True)
class Series:
    """What is kept of a batch: ``partials`` groups its lines by ``keys``; its other columns are sums."""

    keys: tuple[str, ...]
    partials: Callable[[DataFrame], DataFrame]
    answer: Callable[[DataFrame], DataFrame]


def _sums(lines: DataFrame, rules, columns: Sequence[str]) -> DataFrame:
    rows = keep_valid(parsed_transactions(lines, needs(["month_no", *columns], rules)), rules)
    return rows.groupBy("month_no").agg(F.count(F.lit(1)).alias("n"), *[F.try_sum(c).alias(c) for c in columns])


def monthly_value() -> Series:
    """A1: month, n, avg_value."""
    return Series(("month_no",), lambda lines: _sums(lines, tx_value_time(), ["value"]), lambda s: s.select(
        month_label("month_no").alias("month"), "n", mean_of(F.col("value"), F.col("n")).alias("avg_value")))


def monthly_gas() -> Series:
    """A5: month, avg_gas, avg_gas_price."""
    return Series(("month_no",), lambda lines: _sums(lines, tx_gas(), ["gas", "gas_price"]), lambda s: s.select(
        month_label("month_no").alias("month"), mean_of(F.col("gas"), F.col("n")).alias("avg_gas"),
        mean_of(F.col("gas_price"), F.col("n")).alias("avg_gas_price")))


def scam_monthly(registry: DataFrame, dedupe: bool = True) -> Series:
    """A9: month, category, total_value, for the registry as it is when files are added."""
    def partials(lines: DataFrame) -> DataFrame:
        return limb_sums(ledger.scam_value_rows(lines, registry, dedupe), ["month_no", "category"], "value_wei", "copies")

    def answer(sums: DataFrame) -> DataFrame:
        totals = sums_to_totals(sums, ["month_no", "category"], "total_value")
        return totals.select(month_label("month_no").alias("month"), "category", "total_value")

    return Series(("month_no", "category", "limb"), partials, answer)


def known_files(spark: SparkSession, store: str) -> set[str]:
    """Names of the files whose sums the store holds."""
    try:
        return {r["file"] for r in spark.read.schema("file string").parquet(store).where(F.col("file").isNotNull()).collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def add_files(spark: SparkSession, store: str, series: Series, path) -> list[str]:
    """Add the sums of the files under ``path`` that the store has not seen; their names."""
    known = known_files(spark, store)
    new = sorted(f for f in set(spark.read.text(path).inputFiles()) if f not in known)
    if new:
        sums = series.partials(spark.read.text(new))
        named = spark.createDataFrame([(f,) for f in new], "file string")
        rows = sums.withColumn("file", F.lit(None).cast("string")).unionByName(named, allowMissingColumns=True)
        rows.write.mode("append").parquet(store)
    return new


def answer(spark: SparkSession, store: str, series: Series) -> DataFrame:
    """The series over all files added so far, from the store alone."""
    held = spark.read.parquet(store).where(F.col("file").isNull()).drop("file")
    sums = [F.try_sum(c).cast(held.schema[c].dataType).alias(c) for c in held.columns if c not in series.keys]
    return series.answer(held.groupBy(*series.keys).agg(*sums))
