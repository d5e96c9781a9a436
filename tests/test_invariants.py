"""Invariants of the published numbers, checked on the derived test tables."""

from pyspark.sql import functions as F

from chaintally.functions.scalar import month_label
from chaintally.operators.validate import keep_valid, tx_gas, tx_value_time
from chaintally.plans import binding as B
from chaintally.plans import ledger as L
from chaintally.sources.lines import with_fields
from chaintally.sources.parsed import parsed_transactions
from chaintally.sources.registry import scan_registry

from conftest import SF_SMALL


def test_monthly_counts_add_up_to_valid_lines(spark):
    txl = B.export_lines(spark, SF_SMALL, "tx_part")
    valid = keep_valid(with_fields(txl), tx_value_time()).count()
    monthly = L.monthly_value(txl).agg(F.sum("n")).first()[0]
    assert monthly == valid > 0


def test_count_weighted_monthly_gas_equals_overall_mean(spark):
    txl = B.export_lines(spark, SF_SMALL, "tx_part")
    parsed = parsed_transactions(txl)
    rows = keep_valid(parsed, tx_gas()).select(F.col("gas").alias("g"))
    overall = rows.agg(F.avg("g")).first()[0]
    counts = {r.month: r.n for r in L.monthly_value(txl).collect()}
    gas = L.monthly_gas(txl).collect()
    n = keep_valid(with_fields(txl), tx_gas()).count()
    # monthly_value's counts use another rule set; weight by the gas rule's own counts
    per_month = keep_valid(parsed, tx_gas()).groupBy(month_label("month_no").alias("month")).count().collect()
    weights = {r.month: r["count"] for r in per_month}
    weighted = sum(r.avg_gas * weights[r.month] for r in gas) / n
    assert abs(weighted - float(overall)) < 1e-9 * float(overall)
    assert set(weights) <= set(counts)


def test_set_mode_never_exceeds_bag_mode(spark):
    txs = B.export_lines(spark, SF_SMALL, "tx_supplier")
    path = B.export_path(spark, SF_SMALL, "registry")
    reg = scan_registry(spark, path)
    set_mode = {r.scam_id: int(r.total_value) for r in L.scam_id_totals(txs, reg).collect()}
    bag_mode = {r.scam_id: int(r.total_value) for r in L.scam_id_totals(txs, reg, dedupe=False).collect()}
    assert set(set_mode) == set(bag_mode) and set_mode
    assert all(set_mode[k] <= bag_mode[k] for k in set_mode)
    assert any(set_mode[k] < bag_mode[k] for k in set_mode)
    monthly = L.scam_monthly(txs, reg)
    by_cat = {r.category: int(r.total_value) for r in L.scam_category_totals(monthly).collect()}
    summed = {}
    for r in monthly.collect():
        summed[r.category] = summed.get(r.category, 0) + int(r.total_value)
    assert by_cat == summed


def test_naive_contracts_are_a_subset_of_quoted(spark):
    c = B.export_lines(spark, SF_SMALL, "contracts")
    naive = {r.address for r in L.contract_addresses(c, "naive").collect()}
    quoted = {r.address for r in L.contract_addresses(c, "quoted").collect()}
    assert naive < quoted


def test_overhead_columns_add_up_to_total(spark):
    docs = B.table(spark, SF_SMALL, "documents")
    cols = sum(r.bits for r in L.overhead_columns(docs, B.HEX_DOCUMENT_COLUMNS).collect())
    assert cols == L.overhead_total(docs, B.HEX_DOCUMENT_COLUMNS).first().total_bits
