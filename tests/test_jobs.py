"""Command-line jobs end to end on staged export files."""

import json

import pytest

from chaintally.jobs import JOB_TABLE, JOBS, Inputs, parser, run
from chaintally.operators.validate import observed_report, quality_report, tx_value_time
from chaintally.plans import binding as B
from chaintally.plans import ledger as L
from chaintally.session import staging_path
from chaintally.sources.lines import scan_lines
from chaintally.sources.parsed import parsed_transactions
from chaintally.sources.registry import scan_registry
from chaintally.sources.results import newest

from conftest import SF_SMALL


def test_every_published_question_has_a_job():
    assert set(JOBS) == {"monthly-value", "top-contracts", "top-miners", "overhead", "monthly-gas",
                         "mean-gas", "gas-vs-mean", "top-scams", "scam-monthly"}


def test_jobs_write_the_questions_answers(spark):
    tx = B.export_path(spark, SF_SMALL, "tx_supplier")
    txp = B.export_path(spark, SF_SMALL, "tx_part")
    contracts = B.export_path(spark, SF_SMALL, "contracts")
    blocks = B.export_path(spark, SF_SMALL, "blocks_header")
    registry = B.export_path(spark, SF_SMALL, "registry")

    out = staging_path(spark, "job-monthly")
    run(spark, ["monthly-value", "--transactions", txp, "--out", out, "--quality"])
    got = sorted((r.month, r.n) for r in spark.read.json(newest(spark, f"{out}/result")).collect())
    want = sorted((r.month, r.n) for r in L.monthly_value(scan_lines(spark, txp)).collect())
    assert got == want
    q = spark.read.json(newest(spark, f"{out}/quality/transactions")).collect()
    assert sum(r.n for r in q) == scan_lines(spark, txp).count()

    out = staging_path(spark, "job-scams")
    run(spark, ["top-scams", "--transactions", tx, "--registry", registry, "--out", out, "--pairs"])
    doc = json.loads(spark.read.text(newest(spark, f"{out}/pairs")).first().value)
    want = [[r.scam_id, int(r.total_value)] for r in
            L.top_scams(scan_lines(spark, tx), scan_registry(spark, registry)).collect()]
    assert doc == want          # exact wei digits survive the write / read / pair-list round trip

    out = staging_path(spark, "job-miners")
    run(spark, ["top-miners", "--blocks", blocks, "--out", out, "--format", "parquet"])
    assert spark.read.parquet(newest(spark, f"{out}/result")).count() == 10

    out = staging_path(spark, "job-overhead")
    run(spark, ["overhead", "--blocks", blocks, "--out", out])
    rows = {r.column: r.bits for r in spark.read.json(newest(spark, f"{out}/result")).collect()}
    assert rows["total"] == sum(v for k, v in rows.items() if k != "total")

    out = staging_path(spark, "job-gas")
    run(spark, ["gas-vs-mean", "--transactions", txp, "--contracts", contracts, "--out", out])
    assert {r.side for r in spark.read.json(newest(spark, f"{out}/result")).collect()} <= {"above", "below"}

    ing = staging_path(spark, "job-ingest")
    run(spark, ["ingest", "--transactions", txp, "--out", ing])
    out = staging_path(spark, "job-monthly-parsed")
    run(spark, ["monthly-value", "--transactions", f"{ing}/transactions", "--parsed", "--out", out])
    assert sorted((r.month, r.n) for r in spark.read.json(newest(spark, f"{out}/result")).collect()) == want_monthly(spark, txp)


def want_monthly(spark, txp):
    return sorted((r.month, r.n) for r in L.monthly_value(scan_lines(spark, txp)).collect())


def test_block_job_quality_report_counts_every_line(spark):
    blocks = B.export_path(spark, SF_SMALL, "blocks_header")
    out = staging_path(spark, "job-miners-quality")
    run(spark, ["top-miners", "--blocks", blocks, "--out", out, "--quality", "--pairs"])
    q = spark.read.json(newest(spark, f"{out}/quality/blocks")).collect()
    assert sum(r.n for r in q) == scan_lines(spark, blocks).count()
    assert {r.reason for r in q} >= {"ok", "empty:miner", "integer:size", "arity"}
    pairs = json.loads(spark.read.text(newest(spark, f"{out}/pairs")).first().value)
    assert len(pairs) == 10


def test_quality_reports_every_input_in_the_question_s_own_scan(spark):
    txp, contracts = B.export_path(spark, SF_SMALL, "tx_part"), B.export_path(spark, SF_SMALL, "contracts_header")
    out = staging_path(spark, "job-quality")
    run(spark, ["gas-vs-mean", "--transactions", txp, "--contracts", contracts, "--out", out, "--quality", "--pairs"])
    q = {r.reason: r.n for r in spark.read.json(newest(spark, f"{out}/quality/transactions")).collect()}
    assert sum(q.values()) == scan_lines(spark, txp).count() and q["number:gas"] > 0
    c = {r.reason: r.n for r in spark.read.json(newest(spark, f"{out}/quality/contracts")).collect()}
    assert sum(c.values()) == scan_lines(spark, contracts).count() and c["header"] == 1
    assert all(isinstance(v, float) for _, v in json.loads(spark.read.text(newest(spark, f"{out}/pairs")).first().value))


def test_quality_adds_no_scan(spark):
    txp = B.export_path(spark, SF_SMALL, "tx_part")
    a = parser().parse_args(["monthly-value", "--transactions", txp, "--out", "x", "--quality"])
    inputs = Inputs(spark, a, JOB_TABLE["monthly-value"].rules)
    df = JOB_TABLE["monthly-value"].build(inputs)
    rows = df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan text") == 1
    assert rows == L.monthly_value(scan_lines(spark, txp)).collect()
    report = {r.reason: r.n for r in observed_report(spark, inputs.seen["transactions"]).collect()}
    assert report == {r.reason: r.n for r in quality_report(parsed_transactions(scan_lines(spark, txp)), tx_value_time()).collect()}


def test_registry_quality_and_contracts_only(spark):
    tx, registry = B.export_path(spark, SF_SMALL, "tx_supplier"), B.export_path(spark, SF_SMALL, "registry")
    out = staging_path(spark, "job-scam-quality")
    run(spark, ["scam-monthly", "--transactions", tx, "--registry", registry, "--out", out, "--quality"])
    assert {r.reason for r in spark.read.json(newest(spark, f"{out}/quality/registry")).collect()} >= {"ok", "json"}
    txp, contracts = B.export_path(spark, SF_SMALL, "tx_part"), B.export_path(spark, SF_SMALL, "contracts")
    out = staging_path(spark, "job-contracts-only")
    run(spark, ["mean-gas", "--transactions", txp, "--contracts", contracts, "--contracts-only", "--out", out])
    want = L.global_mean_gas(scan_lines(spark, txp), contracts=L.contract_addresses(scan_lines(spark, contracts))).first().avg_gas
    assert spark.read.json(newest(spark, f"{out}/result")).first().avg_gas == want


@pytest.mark.parametrize("argv", [
    ["monthly-value", "--transactions", "x", "--out", "o", "--pairs"],
    ["monthly-value", "--out", "o"],
    ["top-miners", "--blocks", "b", "--out", "o", "--bag"],
    ["top-contracts", "--transactions", "x", "--out", "o"],
    ["mean-gas", "--transactions", "x", "--out", "o", "--contracts-only"],
    ["ingest", "--out", "o"],
])
def test_options_a_job_cannot_use_are_errors(spark, argv):
    with pytest.raises(SystemExit):
        run(spark, argv)
