"""Every operator and question as a query over the star-schema test tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``plans/oracle.py``
holds the DuckDB statement with the same name.  Ledger inputs are derived
from the tables by ``plans/binding.py``; file sources read files the same
job first writes under the checkpoint root.  Totals of the exact questions
are whole-number text of any length (damaged test amounts have 78 digits).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.functions.parse import parse_double, parse_double_compat, parse_gas, parse_long, parse_long_compat
from chaintally.functions.scalar import bits_to_gb, composite_id, hex_bits, month_key, month_label
from chaintally.functions.whole import parse_whole
from chaintally.operators import rank
from chaintally.operators.aggregate import whole_totals
from chaintally.operators.compare import compare_results
from chaintally.operators.registry import address_counts, registry_entries, registry_report
from chaintally.operators.validate import (
    block_any,
    block_miner,
    contract_rules,
    field_count,
    integer,
    keep_valid,
    nonempty,
    not_header,
    numeric,
    numeric_compat,
    outcome_report,
    quality_report,
    reason_counts,
    tx_gas,
    tx_gas_only,
    tx_recipient,
    tx_recipient_time,
    tx_value_time,
    tx_value_time_compat,
)
from chaintally.plans import binding as B
from chaintally.plans import ledger as L
from chaintally.sources.export import scan_blocks, scan_contracts, scan_transactions
from chaintally.sources.lines import field, scan_lines, with_fields
from chaintally.sources.parsed import needs, parsed_transactions
from chaintally.sources.registry import scan_registry
from chaintally.sources.results import (
    load_result,
    read_pair_keys_raw,
    read_pair_result,
    read_rows,
    save_result,
    save_rows,
    save_top_pairs,
)
from chaintally.session import staging_path

Query = Callable[[SparkSession, str], DataFrame]
TX = L.TX


def _double(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _txp(spark, d):
    return B.derived_lines(spark, d, "tx_part")


def _txs(spark, d):
    return B.derived_lines(spark, d, "tx_supplier")


def _staged_path(spark, d, name):
    return B.export_path(spark, d, name)


def _registry(spark, d):
    return scan_registry(spark, _staged_path(spark, d, "registry"))


def _contracts(spark, d):
    return B.derived_lines(spark, d, "contracts")


def _blocks(spark, d):
    return B.derived_lines(spark, d, "blocks")


def _contracts_with_header(spark, d):
    return B.derived_lines(spark, d, "contracts_header")


def _blocks_with_header(spark, d):
    return B.derived_lines(spark, d, "blocks_header")


def _tx_with_header(spark, d):
    return B.derived_lines(spark, d, "tx_part_header")


# --- sources -----------------------------------------------------------------------


def q_scan_lines(spark, d):
    return scan_lines(spark, _staged_path(spark, d, "tx_part_header"))


def q_scan_transactions(spark, d):
    typed = scan_transactions(spark, _staged_path(spark, d, "tx_part_header"))
    return typed.select("hash", "to_address", F.col("value").cast("bigint").alias("value"),
                        "gas", "block_timestamp")


def q_scan_blocks(spark, d):
    return scan_blocks(spark, _staged_path(spark, d, "blocks_header")).select("number", "miner", "size", "timestamp")


def _scan_contracts(spark, d, mode):
    typed = scan_contracts(spark, _staged_path(spark, d, "contracts_header"), csv_mode=mode)
    return typed.select("address", F.size("function_sighashes").alias("n_signatures"), "is_erc20")


def _entries_out(entries: DataFrame) -> DataFrame:
    return entries.select("entry_address", "id", "category",
                          F.size("addresses").alias("n_addresses"))


def q_scan_registry(spark, d):
    return _entries_out(registry_entries(scan_registry(spark, _staged_path(spark, d, "registry"))))


# --- filters and validators ------------------------------------------------------------


def _filtered(lines: DataFrame, rule) -> DataFrame:
    return keep_valid(with_fields(lines), [rule]).select("value")


def q_filter_header(spark, d):
    return _filtered(_tx_with_header(spark, d), not_header(0, "hash"))


def q_filter_lenient(spark, d):
    rows = keep_valid(with_fields(_txp(spark, d)), tx_gas_only(lenient=True))
    return rows.agg(F.count(F.lit(1)).alias("n"),
                    (F.sum(parse_gas(field(TX["gas"]))).cast("double") / F.count(F.lit(1))).alias("avg_gas"))


def q_project_fields(spark, d):
    rows = keep_valid(with_fields(_txp(spark, d)), tx_value_time())
    return rows.select(field(TX["hash"]).alias("hash"), field(TX["to_address"]).alias("to_address"),
                       parse_double(field(TX["value"])).alias("value"),
                       parse_double(field(TX["gas"])).alias("gas"),
                       parse_long(field(TX["block_timestamp"])).alias("block_timestamp"))


def q_project_fields_compat(spark, d):
    """F3, P3 as the published jobs converted numbers: the kind of the value, and its double where it is finite."""
    rows = keep_valid(with_fields(_txp(spark, d)), tx_value_time_compat())
    value = parse_double_compat(field(TX["value"]))
    kind = (F.when(F.isnan(value), F.lit("nan")).when(F.abs(value) == float("inf"), F.lit("infinite")).otherwise(F.lit("finite")))
    return rows.select(field(TX["hash"]).alias("hash"), kind.alias("kind"), F.when(kind == "finite", value).alias("value"),
                       parse_long_compat(field(TX["block_timestamp"])).alias("block_timestamp"))


def q_month_key(spark, d):
    cols = B.tx_columns(B.table(spark, d, "lineitem"))
    ts = parse_long(F.col("block_timestamp"))
    return cols.select("hash", ts.alias("block_timestamp"), month_key(ts).alias("month"))


def q_quality_report(spark, d):
    rules = [field_count(15), not_header(0, "hash")] + tx_value_time()[1:]
    # the outcomes of the parsed form: each field is parsed once for all its rules
    return quality_report(parsed_transactions(_tx_with_header(spark, d), needs([], rules)), rules)


def q_peek_rows(spark, d):
    cols = B.tx_columns(B.table(spark, d, "lineitem"))
    typed = cols.select("hash", parse_long(F.col("block_number")).alias("block_number"),
                        parse_long(F.col("transaction_index")).alias("transaction_index"))
    return typed.orderBy("block_number", "transaction_index").limit(5)


def q_exact_amount(spark, d):
    """P4: whole amounts of up to 78 digits, of both signs, parsed and summed exactly."""
    cols = B.tx_columns(B.table(spark, d, "lineitem"))
    sign = F.when(F.col("__k") % 3 == 0, F.lit("-")).otherwise(F.lit(" +00"))
    wei = parse_whole(F.concat(sign, F.col("value"), F.repeat(F.lit("7"), (F.col("__k") % 70).cast("int"))))
    return whole_totals(cols.select((F.col("__k") % 10).alias("digit"), wei.alias("wei")), ["digit"], "wei", "total_wei")


def q_top_recipients_exact(spark, d):
    """A2, O3 with uint256 amounts: the ten largest exact totals."""
    totals = L.recipient_totals(_txp(spark, d), exact=True)
    return rank.top_k(totals, "total_value", "address", 10)


# --- registry ---------------------------------------------------------------------------------


def q_registry_ids(spark, d):
    entries = registry_entries(_registry(spark, d))
    return entries.select("entry_address", composite_id("id", "category").alias("scam_id"))


def q_registry_addresses(spark, d):
    members = L.scam_members(_registry(spark, d))
    return members.select("address", F.col("id"), "category", "scam_id")


def q_filter_category(spark, d):
    return L.scam_members(_registry(spark, d), B.FILTER_CATEGORIES).select("address", "category")


# --- contracts, gas ---------------------------------------------------------------------


def _top_contracts(spark, d):
    return _double(L.top_contracts(_txp(spark, d), _contracts(spark, d)), "total_value")


def q_filter_in_set(spark, d):
    top = L.top_contracts(_txp(spark, d), _contracts(spark, d))
    rows = L.gas_rows_in_set(_txp(spark, d), top, top=True)
    return rows.groupBy("address").agg(F.count(F.lit(1)).alias("n"))


def q_read_pair_result(spark, d):
    path = staging_path(spark, "top-contracts-pairs")
    save_top_pairs(L.contract_totals(_txp(spark, d), _contracts(spark, d)), path,
                   "address", "total_value", [F.col("total_value").desc(), F.col("address")], 10)
    pairs = read_pair_result(spark, path)
    return pairs.select(F.col("rank").cast("int").alias("rank"), "key",
                        F.col("value").cast("double").alias("total_value"))


def q_trim_chars(spark, d):
    path = staging_path(spark, "top-contracts-pairs")
    save_top_pairs(L.contract_totals(_txp(spark, d), _contracts(spark, d)), path,
                   "address", "total_value", [F.col("total_value").desc(), F.col("address")], 10)
    return read_pair_keys_raw(spark, path)


def q_sink_roundtrip(spark, d):
    path = staging_path(spark, "top-contracts-json")
    save_result(_top_contracts(spark, d), path, fmt="json")
    return load_result(spark, path, fmt="json", schema="address string, total_value double")


def q_saved_series(spark, d):
    """P13: a saved full result (rows as JSON arrays) read back as numbers."""
    path = staging_path(spark, "monthly-value-rows")
    save_rows(L.monthly_value(_txp(spark, d)), path)
    return read_rows(spark, path, "month string, n bigint, avg_value double")


def q_sink_full_result(spark, d):
    """S6: a full result (every month) written by the executors as Parquet
    and read back."""
    path = staging_path(spark, "monthly-value-parquet")
    monthly = L.monthly_value(_txp(spark, d))
    save_result(monthly, path, fmt="parquet")
    return load_result(spark, path, fmt="parquet")


# --- overhead -------------------------------------------------------------------------


def _overhead_columns(spark, d):
    docs = L.overhead_columns(B.table(spark, d, "documents"), B.HEX_DOCUMENT_COLUMNS)
    pages = L.overhead_columns(B.table(spark, d, "pages"), B.HEX_PAGE_COLUMNS)
    return docs.unionByName(pages)


def _overhead_total(spark, d):
    docs = L.overhead_total(B.table(spark, d, "documents"), B.HEX_DOCUMENT_COLUMNS)
    pages = L.overhead_total(B.table(spark, d, "pages"), B.HEX_PAGE_COLUMNS)
    total = docs.select("total_bits").unionByName(pages.select("total_bits")).agg(
        F.sum("total_bits").alias("total_bits"))
    return total.select("total_bits", bits_to_gb("total_bits").alias("total_gb"))


def q_reconcile(spark, d):
    """Each table's columns against its total, from one aggregate a table; then both together."""
    docs = L.overhead_reconcile(B.table(spark, d, "documents"), B.HEX_DOCUMENT_COLUMNS)
    pages = L.overhead_reconcile(B.table(spark, d, "pages"), B.HEX_PAGE_COLUMNS)
    return docs.unionByName(pages).agg(F.sum("sum_of_columns").alias("sum_of_columns"), F.sum("total_bits").alias("total_bits"),
                                       F.bool_and("agrees").alias("agrees"))


def _hex_blocks(spark, d):
    return L.block_hex_frame(_blocks_with_header(spark, d))


def q_hex_bits(spark, d):
    docs = B.table(spark, d, "documents")
    return docs.select("doc_id", *[hex_bits(c).alias(f"{c}_bits") for c in B.HEX_DOCUMENT_COLUMNS])


# --- scams ----------------------------------------------------------------------------------


def _scam_totals(spark, d, dedupe):
    return L.scam_id_totals(_txs(spark, d), _registry(spark, d), dedupe)


def _top_scams(spark, d, dedupe, k=10):
    return L.top_scams(_txs(spark, d), _registry(spark, d), k, dedupe)


def _best_scam(spark, d, dedupe):
    totals = L.scam_id_totals(_txs(spark, d), _registry(spark, d), dedupe)
    return rank.best_row(totals, "scam_id", "total_value")


def _scam_monthly(spark, d, dedupe=True, categories=None):
    return L.scam_monthly(_txs(spark, d), _registry(spark, d), dedupe, categories)


def q_zero_filled(spark, d):
    return rank.zero_fill(_scam_monthly(spark, d), "month", "category", "total_value")


def q_chart_series(spark, d):
    filled = q_zero_filled(spark, d)
    return rank.pivot_series(filled, "month", "category", "total_value", B.ALL_CATEGORIES)


def q_monthly_value_stream(spark, d):
    from chaintally.streaming.monthly import run_monthly_value_stream
    return run_monthly_value_stream(spark, _staged_path(spark, d, "tx_part"),
                                    staging_path(spark, "tx-stream-state"))


def _pq(spark, d, name):
    return B.ingested(spark, d, name)


def q_ingest_transactions(spark, d):
    """The parsed Parquet table, read back (a few columns and outcomes)."""
    t = _pq(spark, d, "tx_part")
    return t.select("hash", "to_address", F.col("value").cast("double").alias("value"),
                    F.when(F.col("month_no").isNotNull(), month_label("month_no")).alias("month"),
                    "ok_arity", "ok_number_value", "ok_integer_block_timestamp")


def q_quality_report_columnar(spark, d):
    """S10, Q1 without a scan: the report of the ingested form from the counts its ingest wrote."""
    rules = [field_count(15), not_header(0, "hash")] + tx_value_time()[1:]
    return outcome_report(B.ingested_outcomes(spark, d, "tx_part_header"), rules)


def q_compare_saved(spark, d):
    """S8: the monthly series against a saved one with planted differences: a month less, a month more, values far and near."""
    now = L.monthly_value(_txp(spark, d))
    month = F.substring("month", 6, 2)
    planted = (now.where(month != "02")
                  .withColumn("avg_value", F.when(month == "03", F.col("avg_value") * 1.000001)
                              .when(month == "04", F.col("avg_value") * (1 + 1e-12)).otherwise(F.col("avg_value")))
                  .withColumn("n", F.when(month == "05", F.col("n") + 1).when(month != "06", F.col("n")))
                  .withColumn("month", F.when(month == "07", F.concat(F.lit("x"), "month")).otherwise(F.col("month"))))
    path = staging_path(spark, "monthly-value-planted")
    save_rows(planted, path)
    saved = read_rows(spark, path, "month string, n bigint, avg_value double")
    return compare_results(now, saved, ["month"]).select("month", "kind", "column")


def _incremental(spark, d, name, series):
    """M: the text files added to a store one batch after the other, one of them twice."""
    from chaintally.streaming import incremental

    files = sorted(spark.read.text(_staged_path(spark, d, name)).inputFiles())
    store = staging_path(spark, f"{name}-store")
    for batch in (files[: len(files) // 2], files[len(files) // 3:]):
        if batch:
            incremental.add_files(spark, store, series, batch)
    return incremental.answer(spark, store, series)


def q_monthly_value_incremental(spark, d):
    from chaintally.streaming.incremental import monthly_value
    return _incremental(spark, d, "tx_part", monthly_value())


def q_monthly_gas_incremental(spark, d):
    from chaintally.streaming.incremental import monthly_gas
    return _incremental(spark, d, "tx_part", monthly_gas())


def q_scam_monthly_incremental(spark, d):
    from chaintally.streaming.incremental import scam_monthly
    return _incremental(spark, d, "tx_supplier", scam_monthly(_registry(spark, d)))


QUERIES: dict[str, Query] = {
    # C1 monthly activity
    "monthly_value": lambda s, d: L.monthly_value(_txp(s, d)),
    "month_key": q_month_key,
    # sources and sinks
    "scan_lines": q_scan_lines,
    "scan_transactions": q_scan_transactions,
    "scan_blocks": q_scan_blocks,
    "scan_contracts": lambda s, d: _scan_contracts(s, d, "quoted"),
    "scan_contracts_compat": lambda s, d: _scan_contracts(s, d, "naive"),
    "scan_registry": q_scan_registry,
    "read_pair_result": q_read_pair_result,
    "sink_roundtrip": q_sink_roundtrip,
    "sink_full_result": q_sink_full_result,
    "saved_series": q_saved_series,
    "trim_chars": q_trim_chars,
    "peek_rows": q_peek_rows,
    # filters, validators, quality
    "filter_arity": lambda s, d: _filtered(_txp(s, d), field_count(15)),
    "filter_nonempty": lambda s, d: _filtered(_txp(s, d), nonempty(TX["to_address"], "to_address")),
    "filter_numeric": lambda s, d: _filtered(_txp(s, d), numeric(TX["value"], "value")),
    "filter_numeric_compat": lambda s, d: _filtered(_txp(s, d), numeric_compat(TX["value"], "value")),
    "filter_integer": lambda s, d: _filtered(_txp(s, d), integer(TX["block_timestamp"], "block_timestamp")),
    "filter_header": q_filter_header,
    "filter_lenient": q_filter_lenient,
    "filter_in_set": q_filter_in_set,
    "filter_category": q_filter_category,
    "valid_tx_value_time": lambda s, d: reason_counts(with_fields(_txp(s, d)), tx_value_time()),
    "valid_tx_value_time_compat": lambda s, d: reason_counts(with_fields(_txp(s, d)), tx_value_time_compat()),
    "valid_tx_recipient": lambda s, d: reason_counts(with_fields(_txp(s, d)), tx_recipient()),
    "valid_tx_recipient_time": lambda s, d: reason_counts(with_fields(_txs(s, d)), tx_recipient_time()),
    "valid_tx_gas": lambda s, d: reason_counts(with_fields(_txp(s, d)), tx_gas()),
    "valid_contract": lambda s, d: reason_counts(with_fields(_contracts_with_header(s, d), "quoted"), contract_rules()),
    "valid_contract_compat": lambda s, d: reason_counts(with_fields(_contracts_with_header(s, d), "naive"), contract_rules()),
    "valid_block_miner": lambda s, d: reason_counts(with_fields(_blocks_with_header(s, d)), block_miner()),
    "valid_block_any": lambda s, d: reason_counts(with_fields(_blocks_with_header(s, d)), block_any()),
    "quality_report": q_quality_report,
    "quality_report_contracts": lambda s, d: quality_report(
        with_fields(_contracts_with_header(s, d), "quoted"), contract_rules()),
    "quality_report_contracts_compat": lambda s, d: quality_report(
        with_fields(_contracts_with_header(s, d), "naive"), contract_rules()),
    "quality_report_registry": lambda s, d: registry_report(_registry(s, d)),
    "quality_report_blocks": lambda s, d: quality_report(with_fields(_blocks_with_header(s, d)), block_miner()),
    "project_fields_compat": q_project_fields_compat,
    "project_fields": q_project_fields,
    "exact_amount": q_exact_amount,
    # registry
    "registry_entries": lambda s, d: _entries_out(registry_entries(_registry(s, d))),
    "registry_ids": q_registry_ids,
    "registry_addresses": q_registry_addresses,
    "registry_counts": lambda s, d: address_counts(L.scam_members(_registry(s, d))),
    # C2 contracts
    "recipient_totals": lambda s, d: _double(L.recipient_totals(_txp(s, d)), "total_value"),
    "recipient_totals_exact": lambda s, d: L.recipient_totals(_txp(s, d), exact=True),
    "top_recipients_exact": q_top_recipients_exact,
    "contract_totals": lambda s, d: _double(L.contract_totals(_txp(s, d), _contracts(s, d)), "total_value"),
    "top_contracts": _top_contracts,
    "top_contracts_compat": lambda s, d: _double(L.top_contracts(
        _txp(s, d), _contracts(s, d), csv_mode="naive", bag=True), "total_value"),
    # C3 miners
    "miner_totals": lambda s, d: L.miner_totals(_blocks(s, d)),
    "top_miners": lambda s, d: L.top_miners(_blocks(s, d)),
    # C4 overhead
    "hex_bits": q_hex_bits,
    "overhead_columns": _overhead_columns,
    "overhead_total": _overhead_total,
    "reconcile_total": q_reconcile,
    "block_overhead_columns": lambda s, d: L.overhead_columns(_hex_blocks(s, d), L.HEX_BLOCK_FIELDS),
    "block_overhead_total": lambda s, d: L.overhead_total(_hex_blocks(s, d), L.HEX_BLOCK_FIELDS),
    "block_reconcile": lambda s, d: L.overhead_reconcile(_hex_blocks(s, d), L.HEX_BLOCK_FIELDS),
    # C5 / C6 gas
    "monthly_gas": lambda s, d: L.monthly_gas(_txp(s, d)),
    "monthly_gas_contracts": lambda s, d: L.monthly_gas(_txp(s, d), L.contract_addresses(_contracts(s, d))),
    "global_mean_gas_contracts": lambda s, d: L.global_mean_gas(_txp(s, d), contracts=L.contract_addresses(_contracts(s, d))),
    "global_mean_gas": lambda s, d: L.global_mean_gas(_txp(s, d)),
    "global_mean_gas_compat": lambda s, d: L.global_mean_gas(_txp(s, d), lenient=True),
    "above_below_mean_compat": lambda s, d: L.above_below_mean(_txp(s, d), _contracts(s, d),
                                                               csv_mode="naive", lenient=True),
    "contract_totals_compat": lambda s, d: _double(L.contract_totals(
        _txp(s, d), _contracts(s, d), csv_mode="naive", bag=True), "total_value"),
    "recipient_mean_gas": lambda s, d: L.recipient_mean_gas(
        _txp(s, d), L.top_contracts(_txp(s, d), _contracts(s, d)), top=True),
    "above_below_mean": lambda s, d: L.above_below_mean(_txp(s, d), _contracts(s, d)),
    # C7 scam ids
    "scam_id_join": lambda s, d: L.scam_value_by_address(_txs(s, d), _registry(s, d)),
    "scam_id_totals": lambda s, d: _scam_totals(s, d, True),
    "scam_id_totals_compat": lambda s, d: _scam_totals(s, d, False),
    "top_scams": lambda s, d: _top_scams(s, d, True),
    "top_scams_compat": lambda s, d: _top_scams(s, d, False),
    "best_scam": lambda s, d: _best_scam(s, d, True),
    "best_scam_compat": lambda s, d: _best_scam(s, d, False),
    # C8 scam categories over time
    "scam_category_join": lambda s, d: L.scam_category_rows(_txs(s, d), _registry(s, d)),
    "scam_monthly": lambda s, d: _scam_monthly(s, d),
    "scam_monthly_compat": lambda s, d: _scam_monthly(s, d, False),
    "scam_category_totals": lambda s, d: L.scam_category_totals(_scam_monthly(s, d)),
    "zero_filled_series": q_zero_filled,
    "chart_series": q_chart_series,
    # streaming form of C1
    "monthly_value_stream": q_monthly_value_stream,
    # the same questions over the once-ingested Parquet form (column pruning,
    # rule outcomes pushed into the scan)
    "ingest_transactions": q_ingest_transactions,
    "monthly_value_columnar": lambda s, d: L.monthly_value(_pq(s, d, "tx_part")),
    "monthly_gas_columnar": lambda s, d: L.monthly_gas(_pq(s, d, "tx_part")),
    "top_contracts_columnar": lambda s, d: _double(L.top_contracts(_pq(s, d, "tx_part"), _contracts(s, d)), "total_value"),
    "above_below_mean_columnar": lambda s, d: L.above_below_mean(_pq(s, d, "tx_part"), _contracts(s, d)),
    "quality_report_columnar": q_quality_report_columnar,
    "compare_saved": q_compare_saved,
    # the monthly series from a store of partial sums, to which files are added
    "monthly_value_incremental": q_monthly_value_incremental,
    "monthly_gas_incremental": q_monthly_gas_incremental,
    "scam_monthly_incremental": q_scam_monthly_incremental,
    # over transactions clustered by recipient: no transaction row moves
    "top_contracts_clustered": lambda s, d: _double(L.top_contracts(B.clustered(s, d, "tx_part"), _contracts(s, d)), "total_value"),
    "above_below_mean_clustered": lambda s, d: L.above_below_mean(B.clustered(s, d, "tx_part"), _contracts(s, d)),
    "top_scams_clustered": lambda s, d: L.top_scams(B.clustered(s, d, "tx_supplier"), _registry(s, d)),
    # hot recipients dealt over salts, for a registry too large to be broadcast
    "scam_monthly_salted": lambda s, d: L.scam_monthly(_txs(s, d), _registry(s, d), salts=16),
    "top_miners_columnar": lambda s, d: L.top_miners(_pq(s, d, "blocks")),
    "top_scams_columnar": lambda s, d: L.top_scams(_pq(s, d, "tx_supplier"), _registry(s, d)),
    "scam_monthly_columnar": lambda s, d: L.scam_monthly(_pq(s, d, "tx_supplier"), _registry(s, d)),
}
