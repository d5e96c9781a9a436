"""Comparison with a saved result, versions of results, damaged saved rows."""

import math

import pytest
from pyspark.sql import functions as F

from chaintally.operators.compare import compare_results
from chaintally.sources.results import load_result, newest, publish, read_rows, save_result, save_rows

SCHEMA = "k string, m int, d double, n long, t string"


def differences(spark, now, saved, keys=("k", "m"), **how):
    found = compare_results(spark.createDataFrame(now, SCHEMA).repartition(3), spark.createDataFrame(saved, SCHEMA), keys, **how)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_each_kind_of_difference(spark):
    saved = [("a", 1, 1.0, 5, "x"), ("b", 1, 2.0, 5, "x"), (None, 1, 3.0, None, None), ("c", None, math.nan, 1, "y"), ("gone", 1, 1.0, 1, "z")]
    now = [("a", 1, 1.0 + 1e-12, 5, "x"), ("b", 1, 2.0 + 1e-6, 6, "x"), (None, 1, 3.0, None, None), ("c", None, math.nan, None, "y"), ("new", 1, 0.0, 1, "z")]
    assert differences(spark, now, saved) == sorted([
        ("b", 1, "different", "d", "2.0", str(2.0 + 1e-6)), ("b", 1, "different", "n", "5", "6"), ("c", None, "different", "n", "1", None),
        ("gone", 1, "missing", None, None, None), ("new", 1, "extra", None, None, None)], key=str)
    assert differences(spark, saved, saved) == []


def test_tolerance_is_relative_and_by_column(spark):
    base = [("a", 1, 1e20, 10, "1")]
    near = [("a", 1, 1e20 * (1 + 1e-10), 10, "1")]
    assert differences(spark, near, base) == [] and len(differences(spark, near, base, tolerance=0)) == 1
    assert len(differences(spark, near, base, tolerance={"n": 0.5})) == 1 and differences(spark, near, base, tolerance={"d": 1e-9}) == []
    # whole numbers and text are exact, zero and infinity are themselves
    assert len(differences(spark, [("a", 1, 1e20, 11, "1.0")], base)) == 2
    assert differences(spark, [("a", 1, 0.0, 1, ""), ("b", 1, math.inf, 1, "")], [("a", 1, -0.0, 1, ""), ("b", 1, math.inf, 1, "")]) == []
    assert len(differences(spark, [("a", 1, math.inf, 1, "")], [("a", 1, 1e308, 1, "")])) == 1


def test_repeated_keys_are_compared_as_bags(spark):
    a = [("k", 1, float(x), 1, "t") for x in (3, 1, 2)]
    assert differences(spark, a, a[::-1]) == []
    assert differences(spark, a, a[:1] + a[2:]) == [("k", 1, "different", "d", "2.0", "1.0"), ("k", 1, "different", "d", "3.0", "2.0"),
                                                    ("k", 1, "extra", None, None, None)]
    with pytest.raises(ValueError, match="columns differ"):
        compare_results(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(a, SCHEMA).drop("t"), ["k"])


def test_a_crash_while_writing_leaves_the_result_before_it(spark, tmp_path):
    path = f"{tmp_path}/result"
    first = spark.range(10).withColumn("v", F.col("id") * 2)
    save_result(first, path)
    broken = spark.range(0, 10_000, numPartitions=4).withColumn("v", F.when(F.col("id") == 9_999, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        save_result(broken, path)
    assert sorted(map(tuple, load_result(spark, path).collect())) == [(k, 2 * k) for k in range(10)]

    def crash(folder):
        spark.range(3).write.parquet(folder)
        raise RuntimeError("after the write, before its publication")

    with pytest.raises(RuntimeError):
        publish(spark, path, crash)
    assert load_result(spark, path).count() == 10
    save_result(spark.range(4).withColumn("v", F.lit(0)), path)
    assert load_result(spark, path).count() == 4


def test_older_versions_go_and_plain_folders_are_read(spark, tmp_path):
    import os

    path = f"{tmp_path}/many"
    folders = [save_result(spark.range(k + 1), path) for k in range(4)]
    assert newest(spark, path) == folders[-1] and load_result(spark, path).count() == 4
    assert [os.path.exists(f) for f in folders] == [False, False, True, True]
    spark.range(7).write.parquet(f"{tmp_path}/plain")
    assert load_result(spark, f"{tmp_path}/plain").count() == 7


def test_damaged_saved_rows_are_left_out_and_counted(spark, tmp_path):
    path = f"{tmp_path}/rows"
    lines = ['["2015/08", 5, 1.5]', '["2015/10", "abc", 2]', '["2015/11", 3]', 'no json', '["2015/12", null, 2.5]', '', '[["2016/01", 7, 1], ["2016/02", 8, "x"]]']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = "month string, n bigint, avg double"
    assert sorted(map(tuple, read_rows(spark, path, schema).collect())) == [("2015/08", 5, 1.5), ("2015/12", None, 2.5), ("2016/01", 7, 1.0)]
    rejects = read_rows(spark, path, schema, with_rejects=True).groupBy("reject_reason").count().collect()
    assert {r[0]: r[1] for r in rejects} == {None: 3, "type:n": 1, "arity": 1, "json": 1, "type:avg": 1}
    save_rows(spark.createDataFrame([("a", 1, 2.0)], schema), f"{tmp_path}/again")
    assert read_rows(spark, f"{tmp_path}/again", schema, True).first().reject_reason is None
