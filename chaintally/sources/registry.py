"""Scam registry source: JSON documents with a dynamic-key ``result`` object.

The published registry is one JSON document on one line:
``{"result": {<address>: {"id": .., "category": .., "addresses": [..]}}}``.
Each line of the input is read as one such document, so a registry split
over many lines (or files) is read by many tasks.  A document is parsed once, to a
VARIANT (its binary form, up to 128 MiB), and its entries stream out of that one
by one; no map of all entries is built.  Where a document repeats a key, the last entry
counts, as when it is read into a dictionary.  A document that is no such JSON, or
has no ``result`` object, keeps its text in the ``_corrupt_record`` column, for the reject lane.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.sources.lines import computed_once

CORRUPT = "_corrupt_record"
# Parsing keeps the last of repeated keys only where this setting allows them.
_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def scan_registry(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Registry documents as ``DataFrame[result: variant, _corrupt_record: string]``.

    ``multi_line=True`` reads pretty-printed files (one document per file).
    """
    return parse_registry(spark.read.text(path, wholetext=multi_line))


def _is_object(variant: Column) -> Column:
    """Only an object can be read as a struct; the field asked for need not be there."""
    return F.try_variant_get(variant, "$", "struct<__none: variant>").isNotNull()


def parse_registry(lines: DataFrame, line: str = "value") -> DataFrame:
    """Registry documents from JSON text lines already in a DataFrame; blank lines are no documents."""
    lines.sparkSession.conf.set(_REPEATED_KEYS, "true")
    text = F.col(line)
    result = F.try_variant_get(F.try_parse_json(text), "$.result", "variant")
    read = computed_once(lines.where(F.length(F.trim(text)) > 0), result.alias("result"), text.alias("text"))
    sound = F.col("result").isNotNull() & _is_object(F.col("result"))
    return read.select(F.when(sound, F.col("result")).alias("result"), F.when(~sound, F.col("text")).alias(CORRUPT))


def stream_entries(registry: DataFrame) -> DataFrame:
    """One row per entry of every document: entry_address, id, category, addresses (NULL where an entry has none)."""
    each = registry.sparkSession.tvf.variant_explode(F.col("result").outer())
    entries = registry.where(F.col("result").isNotNull()).select("result").lateralJoin(each)

    def part(path: str, kind: str, name: str) -> Column:
        return F.try_variant_get("value", path, kind).alias(name)

    return entries.select(F.col("key").alias("entry_address"), part("$.id", "string", "id"), part("$.category", "string", "category"),
                          part("$.addresses", "array<string>", "addresses"))
