"""Joins whose left side has a few keys with a large part of its rows.

``salted_join`` needs neither a broadcast nor a skew-join threshold: the heavy
keys are found by counting, their left rows are dealt over ``salts`` partitions by a
hash of the row, and only their right rows are repeated, once for each salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def heavy_keys(df: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """The keys with more than one in ``salts`` of all rows: fewer than ``salts`` keys.

    The counts are a partial and a final aggregate; the total is summed from the same counts.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("t")).scalar()
    return counts.where(F.col("__n") * salts > total).select(key)


def salted_join(left: DataFrame, right: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Inner join on ``key`` in which a heavy key's left rows meet in ``salts`` tasks instead of one.

    Rows equal in all columns share a salt; such rows are better counted before the join.
    """
    heavy = F.broadcast(heavy_keys(left, key, salts).withColumn("__heavy", F.lit(True)))
    marked = left.join(heavy, key, "left")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns if c != key] or [F.lit(0)]), F.lit(salts)).cast("int")
    dealt = marked.withColumn("__salt", F.when(F.col("__heavy"), salt).otherwise(0)).drop("__heavy")
    repeated = right.join(heavy, key, "left").withColumn("__salt", F.explode(F.when(
        F.col("__heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("__heavy")
    return dealt.join(repeated, [key, "__salt"]).drop("__salt")
