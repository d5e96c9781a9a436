"""Plan shape and the size-dependent join paths."""

import pytest
from pyspark.sql import functions as F

from chaintally.operators.validate import observe_quality, quality_report, tx_value_time
from chaintally.plans import binding as B
from chaintally.plans import ledger as L
from chaintally.session import staging_path
from chaintally.sources.lines import with_fields
from chaintally.sources.parsed import ingest_blocks, ingest_transactions
from chaintally.sources.registry import scan_registry

from conftest import SF_SMALL
from tools.plan_shapes import final_plan as plan


@pytest.fixture
def inputs(spark):
    tx = B.export_lines(spark, SF_SMALL, "tx_part")
    txs = B.export_lines(spark, SF_SMALL, "tx_supplier")
    contracts = B.export_lines(spark, SF_SMALL, "contracts")
    reg = scan_registry(spark, B.export_path(spark, SF_SMALL, "registry"))
    return tx, txs, contracts, reg


BUILDERS = {
    "c1": lambda tx, txs, contracts, reg: L.monthly_value(tx),
    "c2": lambda tx, txs, contracts, reg: L.top_contracts(tx, contracts),
    "c5": lambda tx, txs, contracts, reg: L.monthly_gas(tx, L.contract_addresses(contracts)),
    "c6": lambda tx, txs, contracts, reg: L.above_below_mean(tx, contracts),
    "c6 lenient": lambda tx, txs, contracts, reg: L.above_below_mean(tx, contracts, lenient=True),
    "c7": lambda tx, txs, contracts, reg: L.top_scams(txs, reg),
    "c7 bag": lambda tx, txs, contracts, reg: L.top_scams(txs, reg, dedupe=False),
    "c8": lambda tx, txs, contracts, reg: L.scam_monthly(txs, reg),
    "c8 bag": lambda tx, txs, contracts, reg: L.scam_monthly(txs, reg, dedupe=False),
}


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_building_a_plan_runs_no_job(spark, inputs):
    tracker = spark.sparkContext.statusTracker()
    blocks = B.export_lines(spark, SF_SMALL, "blocks")
    spark.sparkContext.setJobGroup("only-plans", "builders")
    try:
        for build in BUILDERS.values():
            build(*inputs)
        L.top_miners(blocks)
        assert list(tracker.getJobIdsForGroup("only-plans")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_answers_do_not_depend_on_broadcasts(spark, inputs, request):
    on = {k: sorted(b(*inputs).collect()) for k, b in BUILDERS.items()}
    joins = plan_after_run(L.contract_totals(inputs[0], inputs[2]))
    assert "BroadcastHashJoin" in joins
    request.getfixturevalue("no_broadcast")
    off = {k: sorted(b(*inputs).collect()) for k, b in BUILDERS.items()}
    assert on == off


def plan_after_run(df):
    df.collect()
    return plan(df)


def test_contract_join_adds_no_exchange(spark, inputs, no_broadcast):
    text = plan_after_run(L.contract_totals(inputs[0], inputs[2]))
    # both sides arrive hash-partitioned by address from their own aggregates
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_scams_take_one_join_and_one_aggregate(spark, inputs):
    _, txs, _, reg = inputs
    text = plan_after_run(L.scam_monthly(txs, reg))
    assert text.count("FileScan text") == 2                       # transactions once, registry once
    assert text.count("Join [address") == 1
    above = text[:text.index("Join [address")]
    assert above.count("partial_try_sum") + above.count("partial_sum") >= 1
    # one aggregate of transactions by limb; the second joins a few limbs per result row
    assert above.count("Exchange hashpartitioning") == 2
    assert "TakeOrderedAndProject" in plan(L.top_scams(txs, reg))


def test_hot_address_is_split_where_nothing_is_broadcast(spark, lines, no_broadcast):
    """A third of the rows go to one listed address: the join's skewed partition is
    split, and the sums are those of plain Python."""
    from test_ledger import registry_lines
    from test_validate import tx

    rows, want = [], 0
    for i in range(6000):
        hot = i % 3 == 0
        rows.append(tx(to_address="0xa" if hot else f"0x{i}", value=str(10 ** 18 + i), input="0x" + "ab" * 20))
        want += 10 ** 18 + i if hot else 0
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = L.scam_monthly(lines(rows, 8), registry_lines(lines))
        text = plan_after_run(df)
        assert "skew=true" in text
        assert {r.category: int(r.total_value) for r in df.collect()} == {"Phishing": want}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("lenient", [False, True])
def test_one_scan_for_the_gas_comparison(spark, inputs, lenient):
    tx, _, contracts, _ = inputs
    text = plan_after_run(L.above_below_mean(tx, contracts, lenient=lenient))
    assert "Expand" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # transactions once, contracts once; the grand total reads the profile's exchange again
    assert text.count("FileScan text") == 2 and "ReusedExchange" in text, text


def test_observe_quality_counts_without_a_second_scan(spark, inputs):
    tx = inputs[0]
    observed, obs = observe_quality(with_fields(tx), tx_value_time())
    lines = observed.count()
    want = {r.reason: r.n for r in quality_report(with_fields(tx), tx_value_time()).collect()}
    got = dict(obs.get)
    assert got.pop("lines") == lines == tx.count()
    assert {k: n for k, n in got.items() if n} == want


def test_ingest_functions_round_trip(spark, inputs):
    tx = inputs[0]
    src = staging_path(spark, "ingest-src")
    tx.write.text(src)
    parsed = ingest_transactions(spark, src, staging_path(spark, "ingest-out"), partition_by="month_no")
    assert sorted(L.monthly_value(parsed).collect()) == sorted(L.monthly_value(tx).collect())
    month = 1996 * 12
    monthly = L.monthly_value(parsed.where(F.col("month_no") == month))
    assert [r.month for r in monthly.collect()] == ["1996/01"]
    assert f"PartitionFilters: [isnotnull(month_no" in monthly._jdf.queryExecution().executedPlan().toString()
    # a file per month, not one per month and task; rejected lines keep their text
    assert len(parsed.inputFiles()) <= 2 * parsed.select("month_no").distinct().count()
    rejected = parsed.where(F.col("rejected_line").isNotNull())
    assert rejected.count() == parsed.where("not (ok_arity and ok_number_value and ok_integer_value and ok_number_gas and ok_number_gas_price"
                                            " and ok_integer_block_timestamp and ok_range_block_timestamp and ok_empty_to_address)").count() > 0
    blocks_src = staging_path(spark, "ingest-blocks")
    B.export_lines(spark, SF_SMALL, "blocks").write.text(blocks_src)
    pb = ingest_blocks(spark, blocks_src, staging_path(spark, "ingest-blocks-out"))
    assert sorted(L.top_miners(pb).collect()) == sorted(L.top_miners(B.export_lines(spark, SF_SMALL, "blocks")).collect())


def test_scan_stage_is_one_codegen_span(spark, inputs):
    df = L.monthly_value(inputs[0])
    df.collect()
    lines = [line.strip() for line in plan(df).splitlines()]
    stage = [line for line in lines if any(op in line for op in (
        "Generate inline", "Filter (", "partial_count"))]
    assert stage and all(line.startswith("+- *(") or line.startswith("*(") for line in stage)
    assert "PythonUDF" not in plan(df) and "BatchEvalPython" not in plan(df)
