"""Transactions clustered by recipient: a bucketed table written once by the ingest.

Questions that total or join by recipient read the rows of an address from one
bucket, so no transaction row moves.  An address with more than
its share of all rows would make its bucket the slowest task, so its rows go to a second table that
is spread evenly; there the usual partial aggregate collapses it.  The two tables share no address, so
a result per address is the union of the results of both (``parts``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.operators.skew import heavy_keys

KEY = "to_address"
# An address is hot from this many buckets' worth of rows on average.
HOT_BUCKETS = 2


@dataclass(frozen=True)
class Clustered:
    """The parsed transactions of a clustered ingest."""

    rest: DataFrame
    hot: DataFrame

    @property
    def columns(self) -> list[str]:
        return self.rest.columns


def parts(tx) -> list[DataFrame]:
    """The tables of clustered transactions, which share no recipient; a plain frame is its only part."""
    return [tx.rest, tx.hot] if isinstance(tx, Clustered) else [tx]


def ingest_clustered(parsed: DataFrame, path: str, table: str, buckets: int) -> Clustered:
    """Write parsed transactions bucketed and sorted by recipient; ``table`` names the bucketed part in the session's catalog.

    ``parsed`` is read three times, so it should be the ingested Parquet form.  Each bucket is one file, written by one task.
    """
    spark = parsed.sparkSession
    # a few addresses: fewer than ``buckets`` have so many rows
    hot = F.broadcast(heavy_keys(parsed, KEY, max(1, buckets // HOT_BUCKETS)))
    parsed.join(hot, KEY, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    rest = parsed.join(hot, KEY, "left_anti").repartition(buckets, KEY)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rest.write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{path}/rest").saveAsTable(table)
    return Clustered(spark.table(table), spark.read.parquet(f"{path}/hot"))


def open_clustered(spark: SparkSession, path: str, table: str, buckets: int) -> Clustered:
    """The tables of an earlier ingest, named in this session's catalog; no row is read."""
    schema = spark.read.parquet(f"{path}/rest").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}/rest'")
    return Clustered(spark.table(table), spark.read.parquet(f"{path}/hot"))
