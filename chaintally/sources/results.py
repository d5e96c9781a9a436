"""Result sinks and the saved-result source.

A saved row is a JSON array of its values, text quoted and numbers bare
(``["2015/08", 85609, 4.8E20]``); digits are written and read as text, so a
25-digit wei total keeps every one.

Results are written by the executors (``df.write``), never collected to the
driver, each into a version of its own that is published when it is complete (``publish``); readers
take the newest.  A plain folder without versions is read as it is.  The one exception is the pair-list format ``[[key, value], ...]`` of
the published top-k results, which is a single JSON document: it is only
written for a result with an explicit row bound (``limit``), so the one
task that assembles it holds at most ``limit`` rows.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.functions.scalar import trim_chars
from chaintally.functions.whole import WHOLE
from chaintally.session import delete_folders
from chaintally.sources.lines import computed_once


# --- versions: a result is written whole, then published ------------------------------

MANIFEST = "published"
# Versions kept besides the newest.
KEPT_VERSIONS = 1


def publish(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = KEPT_VERSIONS) -> str:
    """Write a new version of a result with ``write(folder)``, then publish it; return its folder.

    A version is written to a folder of its own.  Only when that is complete does one small
    file, appended to the manifest by a committed write, make it the newest; a crash
    before that leaves the version before it as it was.  Versions older than the
    ``keep`` before the newest are then deleted.
    """
    known = _versions(spark, path)
    number = max((n for n, _ in known), default=0) + 1
    name = f"version-{number:06d}-{uuid.uuid4().hex[:8]}"
    write(f"{path}/{name}")
    row = spark.range(1).select(F.lit(number).cast("long").alias("number"), F.lit(name).alias("folder"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")
    delete_folders(spark, [f"{path}/{folder}" for n, folder in known if n < number - keep])
    return f"{path}/{name}"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the published versions; a version is one row."""
    try:
        return [(r["number"], r["folder"]) for r in spark.read.schema("number long, folder string").parquet(f"{path}/{MANIFEST}").collect()]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def newest(spark: SparkSession, path: str) -> str:
    """Folder of the newest published version; the path itself where nothing was published (a plain folder)."""
    known = _versions(spark, path)
    return f"{path}/{max(known)[1]}" if known else path


def save_result(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: str | None = None) -> str:
    """Save a full result (every row) with the DataFrame writer as a new version; return its folder."""
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return publish(df.sparkSession, path, writer.save)


def load_result(spark: SparkSession, path: str, fmt: str = "parquet",
                schema=None) -> DataFrame:
    """The newest version of a saved result."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(newest(spark, path))


def number_text(c, dtype: T.DataType) -> Column:
    """A number as JSON text: a decimal without trailing zeros, others as Spark prints them."""
    if isinstance(dtype, T.DecimalType):
        whole = c.cast(T.DecimalType(dtype.precision, 0))
        plain = F.when(c % F.lit(1) == 0, whole.cast("string")).otherwise(F.rtrim(c.cast("string"), F.lit("0")))
        return F.coalesce(plain, F.lit("null"))
    return F.coalesce(c.cast("string"), F.lit("null"))


def _json_row(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns of a row as one JSON array."""
    def item(name):
        c, dtype = F.col(name), df.schema[name].dataType
        if df.schema[name].metadata == WHOLE:
            return F.coalesce(c, F.lit("null"))
        if isinstance(dtype, T.NumericType):
            return number_text(c, dtype)
        quoted = F.to_json(F.array(c.cast("string")))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2)

    return F.concat(F.lit("["), F.concat_ws(", ", *[item(n) for n in columns]), F.lit("]"))


def save_top_pairs(df: DataFrame, path: str, key: str, value: str,
                   order: list, limit: int) -> str:
    """Save the first ``limit`` rows as one JSON document ``[[key, value], ...]``, as a new version; return its folder."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    top = df.orderBy(*order).limit(limit)
    rank = F.row_number().over(Window.orderBy(*order)).alias("rank")
    ranked = top.select(F.struct(rank, _json_row(df, [key, value]).alias("pair")).alias("item"))
    doc = ranked.agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["pair"]), ", "), F.lit("]")).alias("value"))
    return publish(df.sparkSession, path, doc.coalesce(1).write.text)


def save_rows(df: DataFrame, path: str) -> str:
    """Save a full result as text, one JSON array per row, written by the executors, as a new version; return its folder."""
    return publish(df.sparkSession, path, df.select(_json_row(df, df.columns).alias("value")).write.text)


def _items(spark: SparkSession, path: str) -> DataFrame:
    """(line, pos, item) of every saved row: a line holds one array, or an array of them; a line that is neither has a NULL item."""
    docs = spark.read.text(newest(spark, path)).where(F.length(F.trim("value")) > 0)
    many = F.ltrim("value").startswith("[[")
    listed = F.from_json(F.when(many, F.col("value")).otherwise(F.concat(F.lit("["), F.col("value"), F.lit("]"))),
                         "array<array<string>>")
    return docs.select(F.col("value").alias("line"), F.posexplode_outer(listed).alias("pos", "item"))


def read_rows(spark: SparkSession, path: str, schema: str, with_rejects: bool = False) -> DataFrame:
    """Saved rows as typed columns: element i is column i of ``schema``.

    A damaged row does not fail the job: ``with_rejects=False`` leaves it out, ``True`` keeps every
    row with ``reject_reason`` (NULL when sound; "json", "arity" or "type:<column>") and its text
    in ``line``, so rejects can be counted.
    """
    fields = T.StructType.fromDDL(schema).fields
    item = F.col("item")
    values = [F.get(item, F.lit(i)).try_cast(f.dataType) for i, f in enumerate(fields)]
    reason = F.when(item.isNull(), F.lit("json")).when(F.size(item) != len(fields), F.lit("arity"))
    for i, (f, v) in enumerate(zip(fields, values)):
        reason = reason.when(v.isNull() & F.get(item, F.lit(i)).isNotNull(), F.lit(f"type:{f.name}"))
    read = computed_once(_items(spark, path), *[v.alias(f.name) for f, v in zip(fields, values)], reason.alias("reject_reason"), F.col("line"))
    return read if with_rejects else read.where(F.col("reject_reason").isNull()).drop("reject_reason", "line")


def read_pair_result(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(rank, key, value)`` of a saved ``[[key, value], ...]`` result.

    ``value`` stays text so 25-digit wei totals keep every digit (cast it
    where a number is needed).
    """
    return _items(spark, path).where(F.col("item").isNotNull()).select((F.col("pos") + 1).alias("rank"), F.get("item", F.lit(0)).alias("key"),
                                      F.get("item", F.lit(1)).alias("value"))


def read_pair_keys_raw(spark: SparkSession, path: str, chars: str = ' []"') -> DataFrame:
    """Keys of a saved pair list read the plain-text way: split the text on
    commas, keep every second piece, strip brackets, quotes and blanks."""
    docs = spark.read.text(newest(spark, path))
    pieces = docs.select(F.posexplode(F.split("value", ",", -1)).alias("pos", "piece"))
    return (pieces.where(F.col("pos") % 2 == 0)
            .select((F.col("pos") / 2 + 1).cast("int").alias("rank"), trim_chars("piece", chars).alias("key")))
