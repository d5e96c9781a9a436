"""Grouped sums, counts and means.

Every aggregate is a plain ``groupBy().agg()``, which Spark plans as a
partial aggregate before the shuffle and a final one after it (map-side
combine), so a hot key — one address holding a third of all rows — is
reduced to one row per task before anything moves.  Sums are exact
(decimal or integer); means are taken at the end as ``sum / count`` in
double, so the answer does not depend on the order rows arrive in.  A decimal
sum beyond its type is NULL instead of a failed job; as no input is NULL, that
is the only meaning of a NULL total.  Whole numbers are summed as text of any
length, by limbs (``whole_totals``), and have no such bound.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaintally.functions.scalar import mean_of
from chaintally.functions.whole import SUM, as_whole, digits_of, limbs


def totals_by(df: DataFrame, keys: Sequence[str], value, alias: str = "total_value",
              count_alias: str | None = None) -> DataFrame:
    """Sum of ``value`` per key (optionally with the row count)."""
    value = F.col(value) if isinstance(value, str) else value
    aggs = [F.try_sum(value).alias(alias)]
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    return df.groupBy(*keys).agg(*aggs)


def means_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column],
             count_alias: str | None = "n") -> DataFrame:
    """Mean of each measure per key, from exact sums and one count."""
    sums = [F.try_sum(c).alias(f"__sum_{name}") for name, c in measures.items()]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *sums)
    out = [F.col(k) for k in keys]
    if count_alias:
        out.append(F.col("__n").alias(count_alias))
    out += [mean_of(F.col(f"__sum_{name}"), F.col("__n")).alias(name) for name in measures]
    return grouped.select(*out)


def global_mean(df: DataFrame, measure: Column, alias: str) -> DataFrame:
    """One-row frame with the mean of ``measure`` over all rows."""
    return df.agg(mean_of(F.try_sum(measure), F.count(F.lit(1))).alias(alias))


def limb_sums(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Sums of the limbs of ``value`` (whole-number text) per key: keys, limb, part.

    A number of up to 18 digits is one limb and one row; a longer one is as many
    rows as it has limbs.  The sums are a partial and a final aggregate, so a hot
    key moves one row per limb and task.  They can be added up again, in any grouping.
    """
    part = F.col("__part").cast(SUM)
    if weight is not None:
        part = (part * F.col(weight).cast("decimal(18,0)")).cast(SUM)
    kept = [*keys, *([weight] if weight is not None else [])]
    cut = df.select(*kept, F.posexplode(limbs(value)).alias("limb", "__part"))
    return cut.groupBy(*keys, "limb").agg(F.sum(part).cast(SUM).alias("part"))


def sums_to_totals(sums: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """The totals of limb sums, as whole-number text: one row per key, which holds a few limbs."""
    # a limb that no number of the key reaches is 0
    placed = F.map_from_entries(F.collect_list(F.struct("limb", "part")))
    grouped = sums.groupBy(*keys).agg(placed.alias("__limbs"), F.max("limb").alias("__top"))
    every = F.transform(F.sequence(F.lit(0), F.col("__top")), lambda i: F.coalesce(F.try_element_at("__limbs", i), F.lit(0).cast(SUM)))
    return grouped.select(*keys, as_whole(digits_of(every), alias))


def whole_totals(df: DataFrame, keys: Sequence[str], value: str, alias: str, weight: str | None = None) -> DataFrame:
    """Exact sum of ``value`` (whole-number text of any length; times ``weight``, a whole number) per key, as text."""
    return sums_to_totals(limb_sums(df, keys, value, weight), keys, alias)
