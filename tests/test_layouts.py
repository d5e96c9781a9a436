"""Clustered transactions, salted joins, the store of partial sums, counts without a scan."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chaintally.operators.skew import heavy_keys, salted_join
from chaintally.operators.validate import outcome_report, quality_report, tx_gas, tx_recipient, tx_value_time
from chaintally.plans import ledger as L
from chaintally.session import staging_path
from chaintally.sources.clustered import ingest_clustered, open_clustered
from chaintally.sources.lines import with_fields
from chaintally.sources.parsed import ingest_parsed, parsed_transactions, read_outcomes
from chaintally.sources.registry import parse_registry
from chaintally.streaming import incremental

from test_plans import no_broadcast  # noqa: F401
from test_validate import tx

AUG15, DAY = 1438922527, 86400


def hot_rows(n=900):
    """A third of all rows go to one address."""
    return [tx(to_address="0xhot" if i % 3 == 0 else f"0x{i % 41:02d}", value=str(10 ** 18 + i), gas=str(20_000 + i % 7), block_number=str(i),
               block_timestamp=str(AUG15 + (i % 5) * 40 * DAY)) for i in range(n)] + [tx(value="x"), tx(to_address="")]


def contracts_of(lines):
    return lines([f"0x{k:02d},0x60,,False,False,1" for k in range(41)] + ["0xhot,0x60,,False,False,1"])


def registry_of(lines, listed):
    doc = {"result": {a: {"id": k % 3, "category": "Scamming" if k % 2 else "Phishing", "addresses": [a]} for k, a in enumerate(listed)}}
    return parse_registry(lines([json.dumps(doc)], 1))


@pytest.fixture
def stored(spark, lines):
    """The rows as an ingested table, and clustered by recipient."""
    path = staging_path(spark, "layouts")
    ingest_parsed(parsed_transactions(lines(hot_rows(), 5)), f"{path}/plain")
    plain = spark.read.parquet(f"{path}/plain")
    name = "tx_" + path[-8:]
    return plain, ingest_clustered(plain, f"{path}/clustered", name, 8), f"{path}/clustered", name


def ancestors_of_bucketed_scan(df):
    """Operators between the scan of a bucketed table and the first join above it, in the executed plan."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    at = next(k for k, line in enumerate(text) if "FileScan" in line and "Bucketed: true" in line)
    depth, above = len(text[at]) - len(text[at].lstrip(" :+-")), []
    for line in reversed(text[:at]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            if "Join" in line or "Exchange SinglePartition" in line:      # the latter: one row of sums a task
                break
            above.append(line.strip())
    return above


def test_no_transaction_moves_over_the_clustered_form(spark, lines, stored, no_broadcast):  # noqa: F811
    plain, cl, _, _ = stored
    contracts, reg = contracts_of(lines), registry_of(lines, ["0xhot", "0x01", "0x02"])
    questions = [lambda t: L.top_contracts(t, contracts, 5), lambda t: L.above_below_mean(t, contracts, 5), lambda t: L.top_scams(t, reg)]
    for q in questions:
        assert q(cl).collect() == q(plain).collect()
        above = ancestors_of_bucketed_scan(q(cl))
        assert above and not [line for line in above if "Exchange" in line]


def test_hot_recipient_is_spread_and_shared_by_no_part(stored):
    _, cl, _, _ = stored
    assert {r.to_address for r in cl.hot.select("to_address").distinct().collect()} == {"0xhot"}
    assert cl.rest.where("to_address = '0xhot'").count() == 0 and cl.hot.count() == 300
    assert cl.rest.count() + cl.hot.count() == 902
    assert len(cl.rest.inputFiles()) <= 8


def test_clustered_tables_are_found_again(spark, lines, stored, no_broadcast):  # noqa: F811
    plain, cl, path, name = stored
    spark.sql(f"DROP TABLE {name}")
    again = open_clustered(spark, path, name, 8)
    contracts = contracts_of(lines)
    assert L.top_contracts(again, contracts, 5).collect() == L.top_contracts(plain, contracts, 5).collect()
    assert not [line for line in ancestors_of_bucketed_scan(L.top_contracts(again, contracts, 5)) if "Exchange" in line]


def test_salted_join_deals_the_hot_key(spark, no_broadcast):  # noqa: F811
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("a"), "id")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4), (None, 5)], "a string, m int")
    assert [r.a for r in heavy_keys(left, "a", 16).collect()] == ["hot"]
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        def sizes(df):
            return sorted(r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())

        plain, dealt = left.join(right, "a"), salted_join(left, right, "a")
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect()))
        assert sizes(plain)[-1] >= 20_000
        spread = sizes(dealt)
        assert spread[-1] <= 2 * spread[len(spread) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_salted_series_is_the_series(spark, lines, no_broadcast):  # noqa: F811
    rows = hot_rows() + hot_rows()[:9]
    reg = registry_of(lines, ["0xhot", "0x01", "0x02"])
    t = lines(rows, 6)
    assert L.scam_monthly(t, reg, salts=8).collect() == L.scam_monthly(t, reg).collect()
    assert L.scam_monthly(t, reg, dedupe=False, salts=8).collect() == L.scam_monthly(t, reg, dedupe=False).collect()
    assert L.scam_monthly(lines([tx()], 1).limit(0), reg, salts=8).collect() == []


def test_added_files_give_the_answer_over_all(spark, lines, tmp_path):
    src, store = f"{tmp_path}/in", f"{tmp_path}/store"
    rows = hot_rows()
    series = incremental.monthly_value()
    for k in range(3):
        lines(rows[k::3], 2).write.mode("append").text(src)
        assert len(incremental.add_files(spark, store, series, src)) == 2
        assert incremental.add_files(spark, store, series, src) == []        # a repeated file adds nothing
        want = L.monthly_value(spark.read.text(src)).collect()
        assert incremental.answer(spark, store, series).orderBy("month").collect() == want


def test_old_files_are_not_opened(spark, lines, tmp_path):
    src, store, reg = f"{tmp_path}/in", f"{tmp_path}/store", registry_of(lines, ["0xhot", "0x03"])
    rows = hot_rows()
    series = incremental.scam_monthly(reg)
    lines(rows[::2], 2).write.text(src)
    incremental.add_files(spark, store, series, src)
    for f in os.listdir(src):                                                 # what the old files held is gone
        if f.startswith("part-"):
            open(f"{src}/{f}", "w").close()
        elif f.endswith(".crc"):
            os.replace(f"{src}/{f}", f"{tmp_path}/{f}")
    lines(rows[1::2], 2).write.mode("append").text(src)
    assert len(incremental.add_files(spark, store, series, src)) == 2
    got = incremental.answer(spark, store, series).orderBy("month", "category").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in L.scam_monthly(lines(rows, 3), reg).collect()]


def test_a_failed_addition_adds_nothing(spark, lines, tmp_path):
    src, store, series = f"{tmp_path}/in", f"{tmp_path}/store", incremental.monthly_gas()
    lines(hot_rows(90), 1).write.text(src)
    failing = incremental.Series(series.keys, lambda ls: series.partials(ls).withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("boom")).cast("long"))),
                                 series.answer)
    with pytest.raises(Exception, match="boom"):
        incremental.add_files(spark, store, failing, src)
    assert len(incremental.add_files(spark, store, series, src)) == 1
    assert incremental.answer(spark, store, series).orderBy("month").collect() == L.monthly_gas(lines(hot_rows(90))).collect()


def test_quality_report_reads_the_counts_only(spark, lines, tmp_path):
    rows = hot_rows(60) + [tx(gas="g"), tx(block_timestamp="9" * 20), tx(value="5.7"), "short,line"]
    path = f"{tmp_path}/ingested"
    ingest_parsed(parsed_transactions(lines(rows, 3)), path)
    outcomes = read_outcomes(spark, path)
    assert outcomes.agg(F.sum("n")).first()[0] == len(rows) and len({r.file for r in outcomes.select("file").collect()}) == 3
    for rules in (tx_value_time(), tx_recipient(), tx_recipient(exact=True), tx_gas()):
        got, want = outcome_report(outcomes, rules), quality_report(with_fields(lines(rows)), rules)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert got.inputFiles() and all("ingested_outcomes/" in f for f in got.inputFiles())
