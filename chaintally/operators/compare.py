"""Comparison of a result with a saved one.

Rows meet by key in one null-safe full outer join; repeated keys are numbered in the
order of their values, so bags are compared row by row.  Doubles and decimals may differ by a
relative tolerance; all else, whole-number text included, must be equal.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOLERANCE = 1e-9
MISSING, EXTRA, DIFFERENT = "missing", "extra", "different"


def _alike(now: Column, saved: Column, dtype: T.DataType, tolerance: float) -> Column:
    """Equal, NULL for NULL and NaN for NaN, or numbers within the tolerance of the larger one."""
    equal = now.eqNullSafe(saved)
    if not tolerance or not isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return equal
    a, b = now.cast("double"), saved.cast("double")
    # NaN is beyond infinity here, so neither is near a number
    near = F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b))
    finite = F.abs(a - b) < F.lit(float("inf"))
    return equal | F.coalesce(near & finite, F.lit(False))


def _numbered(df: DataFrame, keys: Sequence[str], columns: Sequence[str], side: str) -> DataFrame:
    """key columns k0.., nth row of its key, and the row's values as one struct."""
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    nth = F.row_number().over(order) if columns else F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    row = F.struct(F.lit(True).alias("here"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    return df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], nth.alias("nth"), row.alias(side))


def compare_results(now: DataFrame, saved: DataFrame, keys: Sequence[str],
                    tolerance: float | Mapping[str, float] = TOLERANCE) -> DataFrame:
    """Differences of ``now`` from ``saved``: the keys, kind, column, saved_value, new_value.

    ``missing``: a saved row that is not there any more; ``extra``: a row that was not saved (for both
    column and values are NULL); ``different``: a value that differs, one row per column.  ``tolerance`` is
    one for all numbers or one by column (0 where it names none).  Both frames must have the same columns.
    """
    if sorted(now.columns) != sorted(saved.columns):
        raise ValueError(f"columns differ: {sorted(now.columns)} and {sorted(saved.columns)}")
    columns = [c for c in now.columns if c not in keys]
    left, right = _numbered(now, keys, columns, "now"), _numbered(saved, keys, columns, "saved")
    same = [left[f"k{i}"].eqNullSafe(right[f"k{i}"]) for i in range(len(keys))] + [left["nth"] == right["nth"]]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    met = left.join(right, condition, "full_outer").select(
        *[F.when(left["now"].isNotNull(), left[f"k{i}"]).otherwise(right[f"k{i}"]).alias(k) for i, k in enumerate(keys)], "now", "saved")

    def difference(kind: str, column: str | None = None, before: Column | None = None, after: Column | None = None) -> Column:
        text = F.lit(None).cast("string")
        return F.struct(F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column"),
                        (text if before is None else before.cast("string")).alias("saved_value"),
                        (text if after is None else after.cast("string")).alias("new_value"))

    each = []
    for i, c in enumerate(columns):
        a, b = F.col(f"now.v{i}"), F.col(f"saved.v{i}")
        allowed = tolerance.get(c, 0.0) if isinstance(tolerance, Mapping) else tolerance
        each.append(F.when(~_alike(a, b, now.schema[c].dataType, allowed), difference(DIFFERENT, c, b, a)))
    nothing = F.array().cast("array<struct<kind:string,column:string,saved_value:string,new_value:string>>")
    found = (F.when(F.col("now").isNull(), F.array(difference(MISSING))).when(F.col("saved").isNull(), F.array(difference(EXTRA)))
              .otherwise(F.array_compact(F.array(*each)) if each else nothing))
    return met.select(*keys, F.explode(found).alias("d")).select(*keys, "d.*")
