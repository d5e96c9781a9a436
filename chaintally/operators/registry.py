"""Registry flattening: entries, address rows, composite ids, counts.

One row per entry of each document; entries without an id or a category
are rejected (``registry_report`` counts them), an entry with an empty or
missing list yields no address rows.  Where a document repeats a key, the last
entry counts, as when the document is read into a dictionary.

The published registry repeats a scam under each of its addresses, each
copy listing all addresses, so joining the raw address rows counts value
once per copy ("bag" mode).  ``counted_members`` keeps one row per
(address, key) with that number of copies; the default set mode counts one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaintally.functions.scalar import composite_id
from chaintally.sources.registry import CORRUPT, stream_entries


def _reason(entries: DataFrame):
    return F.when(F.col("id").isNull(), "id").when(F.col("category").isNull(), "category").otherwise("ok")


def registry_entries(registry: DataFrame) -> DataFrame:
    """One row per valid entry: entry_address, id, category, addresses."""
    return stream_entries(registry).where(F.col("id").isNotNull() & F.col("category").isNotNull())


def registry_report(registry: DataFrame) -> DataFrame:
    """Entries per outcome (documents for ``json``): reason, n, lines, kept, dropped."""
    entries = stream_entries(registry)
    reasons = entries.select(_reason(entries).alias("reason")).union(
        registry.where(F.col(CORRUPT).isNotNull()).select(F.lit("json").alias("reason")))
    everything = Window.partitionBy()
    counted = reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    kept = F.sum(F.when(F.col("reason") == "ok", F.col("n")).otherwise(0)).over(everything)
    return counted.select("reason", "n", F.sum("n").over(everything).alias("lines"), kept.alias("kept")).withColumn(
        "dropped", F.col("lines") - F.col("kept"))


def registry_addresses(entries: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """One row per (listed address, entry): address, id, category, scam_id
    (the composite "<id>_<category>")."""
    if categories is not None:
        entries = entries.where(F.col("category").isin(*categories))
    flat = entries.select("id", "category", F.explode("addresses").alias("address"))
    return flat.select("address", "id", "category",
                       composite_id("id", "category").alias("scam_id"))


def counted_members(members: DataFrame, key: str, dedupe: bool = True) -> DataFrame:
    """One row per distinct (address, key): address, key, copies (1 in set mode)."""
    copies = F.lit(1).cast("long") if dedupe else F.count(F.lit(1))
    return members.groupBy("address", key).agg(copies.alias("copies"))


def address_counts(members: DataFrame, by: str = "category") -> DataFrame:
    """Listed address rows per category (duplicates counted)."""
    return members.groupBy(by).agg(F.count(F.lit(1)).alias("n_addresses"))
