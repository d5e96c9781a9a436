import random

import pytest
from pyspark.sql import functions as F

from chaintally.functions.whole import WHOLE, digits_of, limbs, parse_whole, whole_order
from chaintally.operators.aggregate import limb_sums, sums_to_totals, whole_totals
from chaintally.operators.rank import best_row, top_k
from chaintally.sources.results import newest, save_rows, save_top_pairs

EDGES = ["0", "-0", "+0", "000", " 7 ", "+5", "-9", "9" * 18, "1" + "0" * 18, "-" + "9" * 18, "9" * 36, "9" * 78, "-" + "9" * 78, "1" + "0" * 200,
         "\t12\n", "00000000000000000000012"]


def test_canonical_text_of_any_length(spark):
    bad = ["", "5.7", "1e18", "1_000", "nan", "--5", "+", "0x10", "1 2", None]
    rows = spark.createDataFrame([(t,) for t in EDGES + bad], "t string").select("t", parse_whole("t").alias("w")).collect()
    assert [r.w for r in rows] == [str(int(t)) for t in EDGES] + [None] * len(bad)


def test_limbs_come_back_as_the_number(spark):
    rng = random.Random(0)
    numbers = [str(int(t)) for t in EDGES] + [str(rng.choice([-1, 1]) * rng.getrandbits(rng.randint(1, 600))) for _ in range(200)]
    back = spark.createDataFrame([(t,) for t in numbers], "t string").select(digits_of(limbs("t")).alias("w")).collect()
    assert [r.w for r in back] == numbers


def test_sums_are_exact_for_both_signs_and_any_length(spark):
    rng = random.Random(1)
    rows = [(k % 7, str(rng.choice([-1, 1, 1]) * rng.getrandbits(rng.choice([5, 60, 256, 500]))), rng.randint(1, 1000)) for k in range(3000)]
    rows += [(8, "9" * 78, 1)] * 500 + [(9, "5", 3), (9, "-15", 1), (10, "-1", 1), (10, "1" + "0" * 40, 1)]
    df = spark.createDataFrame(rows, "k int, v string, n long").repartition(6)
    plain, weighted = {}, {}
    for k, v, n in rows:
        plain[k] = plain.get(k, 0) + int(v)
        weighted[k] = weighted.get(k, 0) + int(v) * n
    assert {r.k: int(r.t) for r in whole_totals(df, ["k"], "v", "t").collect()} == plain
    assert {r.k: r.t for r in whole_totals(df, ["k"], "v", "t", "n").collect()} == {k: str(v) for k, v in weighted.items()}
    total = whole_totals(df, [], "v", "t").collect()
    assert [r.t for r in total] == [str(sum(plain.values()))]
    assert whole_totals(df.limit(0), ["k"], "v", "t").collect() == []


def test_limb_sums_add_up_in_any_grouping(spark):
    df = spark.createDataFrame([(k % 3, str(7 ** k)) for k in range(300)], "k int, v string")
    sums = limb_sums(df.where("k < 2"), ["k"], "v").union(limb_sums(df.where("k = 2"), ["k"], "v"))
    one = sums.select(F.lit(0).alias("all"), "limb", "part").groupBy("all", "limb").agg(F.sum("part").cast("decimal(38,0)").alias("part"))
    assert sums_to_totals(one, ["all"], "t").first().t == str(sum(7 ** k for k in range(300)))


@pytest.mark.parametrize("falling", [False, True])
def test_order_is_the_order_of_numbers(spark, falling):
    rng = random.Random(2)
    numbers = list({str(rng.choice([-1, 1]) * rng.getrandbits(rng.randint(1, 300))) for _ in range(300)} | {"0"})
    df = spark.createDataFrame([(t,) for t in numbers], "t string").repartition(3)
    assert [r.t for r in df.orderBy(whole_order("t", falling)).collect()] == sorted(numbers, key=int, reverse=falling)


def test_top_and_best_of_text_totals(spark):
    rows = [("a", "9"), ("b", "10"), ("d", "1" + "0" * 60), ("c", "1" + "0" * 60), ("e", "-5")]
    df = spark.createDataFrame(rows, "k string, t string")
    assert [r.k for r in top_k(df, "t", "k", 3).collect()] == ["c", "d", "b"]
    assert tuple(best_row(df, "k", "t").first()) == ("c", "1" + "0" * 60)
    assert tuple(best_row(df.limit(0), "k", "t").first()) == (None, None)


def test_totals_are_written_bare(spark, tmp_path):
    rows = spark.createDataFrame([("x", "9" * 78), ("y", "1")], "k string, v string")
    totals = whole_totals(rows, ["k"], "v", "total_value")
    assert totals.schema["total_value"].metadata == WHOLE
    save_rows(totals.orderBy("k").coalesce(1), f"{tmp_path}/rows")
    assert [r.value for r in spark.read.text(newest(spark, f"{tmp_path}/rows")).collect()] == [f'["x", {"9" * 78}]', '["y", 1]']
    save_top_pairs(totals, f"{tmp_path}/pairs", "k", "total_value", [F.col("k")], 5)
    assert [r.value for r in spark.read.text(newest(spark, f"{tmp_path}/pairs")).collect()] == [f'[["x", {"9" * 78}], ["y", 1]]']


def test_hot_key_moves_one_row_a_limb_and_task(spark):
    df = spark.range(0, 30_000, numPartitions=5).select((F.col("id") % 3).alias("k"), F.repeat(F.lit("9"), F.lit(40)).alias("v"))
    plan = whole_totals(df, ["k"], "v", "t")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
    assert {r.t for r in whole_totals(df, ["k"], "v", "t").collect()} == {str(10_000 * int("9" * 40))}
