"""Export lines derived where they are read, and the compressed files of the sources that take a path."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chaintally.functions.parse import parse_long
from chaintally.functions.whole import limbs, parse_whole
from chaintally.plans import binding as B
from chaintally.plans.catalog import QUERIES
from chaintally.session import checkpoint_root


@pytest.fixture
def tables(spark, tmp_path):
    """A few rows of the tables the export is derived from, some of them null."""
    day = datetime(1996, 3, 13, 4, 5, 6)
    spark.createDataFrame([(k, k % 7, k % 5, 1 + k % 7, 3.0, 10.5 * k, 0.04, day) for k in range(120)] + [(None,) * 8],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_tax double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k % 9, 7.25 * k, day) for k in range(90)] + [(None,) * 4],
                          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, k) for k in range(12)] + [(None, None)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def staged(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return {os.path.basename(p) for p in glob.glob(f"{root}/staged-*")}


def test_questions_over_lines_write_no_copy_of_the_export(spark, tables):
    before = staged(spark)
    for name in ("valid_block_any", "block_reconcile", "contract_totals_compat", "above_below_mean", "valid_tx_gas"):
        assert QUERIES[name](spark, tables).collect()
    assert staged(spark) == before
    QUERIES["above_below_mean_columnar"](spark, tables).collect()
    assert not [p for p in staged(spark) - before if "parquet" not in p]


@pytest.mark.parametrize("name", ["tx_part", "tx_supplier", "tx_part_header", "contracts_header", "blocks_header"])
def test_staged_files_are_compressed_and_hold_the_derived_lines(spark, tables, name):
    path = B.export_path(spark, tables, name)
    files = glob.glob(path.removeprefix("file:") + "/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
    from_files, derived = spark.read.text(path).collect(), B.derived_lines(spark, tables, name).collect()
    assert sorted(r.value for r in from_files) == sorted(r.value for r in derived)


def test_a_number_too_long_for_a_bigint_is_not_cast(spark):
    texts = {"9223372036854775807": 2**63 - 1, "9223372036854775808": None, "-9223372036854775808": -2**63, "9" * 20: None, "9" * 400: None,
             " +007 ": 7, "0" * 40 + "5": 5, "-0": 0, "": None, "1_0": None, "5.7": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.v for r in df.select("t", parse_long("t").alias("v")).collect()} == texts
    # a plain cast raises on such a number; behind the check it is never reached
    guard = df.where(F.length("t") >= 20).where(~F.col("t").startswith("0") & ~F.col("t").startswith("-"))
    assert parse_long("t")._jc.toString().count("0*") == 1 and guard.where(parse_long("t").isNotNull()).count() == 0


def test_plain_numbers_and_single_limbs_take_the_short_way(spark):
    texts = ["0", "7", "007", "-0", "-12", " +5 ", "9" * 18, "9" * 19, "-" + "9" * 18, "-" + "9" * 37, "9" * 78, None, "x", "5\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_whole("t").alias("w"))
    rows = df.select("t", "w", limbs("w").alias("l")).collect()
    for r in rows:
        whole = None if r.t in (None, "x") else int(r.t)
        assert r.w == (None if whole is None else str(whole))
        if whole is not None:
            assert sum(int(part) * 10 ** (18 * k) for k, part in enumerate(r.l)) == whole
            assert len(r.l) == -(-len(str(abs(whole))) // 18)
        else:
            assert r.l is None
