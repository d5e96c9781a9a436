"""Ordering, top-k, comparison with a mean, and chart shaping.

Top-k is ``orderBy(..).limit(k)``, which Spark runs as
``TakeOrderedAndProject``: every task keeps its own best k and only those
reach the final merge, so no full sort of the input happens.  The key is
always added as a tie-break, so the k-th row is deterministic.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.functions.whole import whole_order
from chaintally.schemas import MONTH_FORMAT
from chaintally.session import materialize


def top_k(df: DataFrame, measure: str, key: str, k: int = 10) -> DataFrame:
    """The k rows with the largest ``measure`` (ties: smaller key first).

    Whole-number text is ordered as numbers.  A NULL decimal total is one
    beyond 38 digits, so it comes before all others.
    """
    return df.orderBy(measure_order(df, measure).desc_nulls_first(), F.col(key).asc()).limit(k)


def measure_order(df: DataFrame, measure: str) -> Column:
    """What a measure is ordered by: itself, or the number it spells."""
    return whole_order(measure) if df.schema[measure].dataType == T.StringType() else F.col(measure)


def best_row(df: DataFrame, key: str, measure: str) -> DataFrame:
    """The single row with the largest measure, as one aggregate pass.

    ``max_by`` alone would pick any row among equal maxima; the smallest
    (falling measure, key) makes the smallest key win a tie.  No row gives one of NULLs, as a maximum does.
    """
    text = df.schema[measure].dataType == T.StringType()
    falling = whole_order(measure, falling=True) if text else -F.col(measure)
    row = F.struct(falling.alias("falling"), F.col(key).alias("key"), F.col(measure).alias("measure"))
    return df.agg(F.min(F.when(F.col(measure).isNotNull(), row)).alias("best")).select(
        F.col("best.key").alias(key), F.col("best.measure").alias(measure))


def above_below(df: DataFrame, measure: str, mean: Column, mean_alias: str = "global_avg",
                side_alias: str = "side") -> DataFrame:
    """Label each row "above" (``>=`` the mean) or "below"."""
    return (df.withColumn(mean_alias, mean)
              .withColumn(side_alias, F.when(F.col(measure) >= F.col(mean_alias), F.lit("above"))
                          .otherwise(F.lit("below"))))


def month_label_to_date(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.concat(c, F.lit("/01")), MONTH_FORMAT + "/dd")


def zero_fill(series: DataFrame, month: str, key: str, value: str,
              materialize_input: bool = True) -> DataFrame:
    """Add a zero row for every month without a value, per key.

    The month axis runs from the first to the last month of the whole
    series (one common axis for all keys).  The axis is generated per key
    with ``sequence`` and ``explode`` — no cross join — and the series is
    attached with a left equi-join on (key, month).

    The series is read by four branches (bounds, keys, values), so it is
    checkpointed first: the job that computes it runs once.
    """
    if materialize_input:
        series = materialize(series)
    first = series.agg(F.min(month_label_to_date(month))).scalar()
    last = series.agg(F.max(month_label_to_date(month))).scalar()
    keys = series.select(key).distinct()
    axis = keys.select(
        key,
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("__d"),
    ).select(key, F.date_format("__d", MONTH_FORMAT).alias(month))
    filled = axis.join(series.select(month, key, value), on=[key, month], how="left")
    return filled.select(month, key, F.coalesce(F.col(value), F.lit(0).cast(
        series.schema[value].dataType)).alias(value))


def pivot_series(series: DataFrame, month: str, key: str, value: str,
                 keys: Sequence[str]) -> DataFrame:
    """Wide chart table: one row per month, one column per listed key.

    Listing the keys avoids the extra job that discovers pivot values and
    fixes the output schema.
    """
    return series.groupBy(month).pivot(key, list(keys)).agg(F.first(value))


def reconcile(sums: DataFrame, columns: Sequence[str], total: str) -> DataFrame:
    """One row: sum of the columns' sums, the total, and whether they agree.

    ``sums`` is the one row of one aggregate, so nothing is read twice.
    """
    parts = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return sums.select(parts.alias("sum_of_columns"), F.col(total).alias("total_bits"), (parts == F.col(total)).alias("agrees"))
