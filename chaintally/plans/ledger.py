"""The published ledger questions as DataFrame programs.

Inputs are line collections (``DataFrame[value: string]``, e.g. from
``scan_lines``) or the parsed tables of ``sources/parsed.py`` (e.g. read
from Parquet after a one-time ingest), and a registry frame
(``scan_registry``).  Each function only builds a plan — no action — so
callers can compose them and Catalyst sees the whole query.

Plan shape, for every question: one scan, the split and the rule checks
fused into the scan stage (whole-stage codegen, no Python), and a partial
aggregate before the shuffle.  Joins carry no hint but for a list of known
length: Spark broadcasts a side by its size in bytes, measured at run time
where it was not known before, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chaintally.functions.scalar import bits_to_gb, hex_bits, mean_of, month_label
from chaintally.operators.aggregate import global_mean, means_by, totals_by, whole_totals
from chaintally.operators.rank import above_below, reconcile, top_k
from chaintally.operators.skew import salted_join
from chaintally.operators.registry import (
    counted_members,
    registry_addresses,
    registry_entries,
)
from chaintally.operators.validate import (
    block_any,
    block_miner,
    contract_rules,
    keep_valid,
    passes,
    tx_gas,
    tx_gas_only,
    tx_recipient,
    tx_recipient_time,
    tx_value_time,
)
from chaintally.schemas import FIELD_INDEX, HEX_BLOCK_FIELDS
from chaintally.sources.clustered import parts
from chaintally.sources.lines import computed_once, field, with_fields
from chaintally.sources.parsed import needs, parsed_blocks, parsed_transactions

TX = FIELD_INDEX["transactions"]
CON = FIELD_INDEX["contracts"]


def _labelled(series: DataFrame) -> DataFrame:
    """A series with its month numbers as labels: the first column becomes ``month``."""
    return series.select(month_label("month_no").alias("month"), *[c for c in series.columns if c != "month_no"])


# --- C1 monthly activity -----------------------------------------------------


def monthly_value(tx_lines: DataFrame) -> DataFrame:
    """Transactions per UTC month and mean value (wei): month, n, avg_value."""
    rules = tx_value_time()
    rows = keep_valid(parsed_transactions(tx_lines, needs(["month_no", "value"], rules)), rules).select("month_no", "value")
    return _labelled(means_by(rows, ["month_no"], {"avg_value": F.col("value")}, "n")).orderBy("month")


# --- C2 top contracts by value received ---------------------------------------


def recipient_totals(tx_lines: DataFrame, exact: bool = False) -> DataFrame:
    """Value received per recipient: address, total_value.

    ``exact=False`` accepts any number text (as the float-based published
    job did) and sums decimals; ``exact=True`` requires whole wei of any length
    and gives whole-number text.
    """
    rules = tx_recipient(exact)
    value = "value_wei" if exact else "value"
    rows = keep_valid(parsed_transactions(tx_lines, needs(["to_address", value], rules)), rules).select(
        F.col("to_address").alias("address"), F.col(value).alias("value"))
    return (whole_totals if exact else totals_by)(rows, ["address"], "value", "total_value")


def contract_addresses(contract_lines: DataFrame, csv_mode: str = "quoted",
                       observed: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Addresses of valid contract lines (one row per line, duplicates kept).

    ``csv_mode='naive'`` splits inside quoted signature lists, as the
    published job did, and so loses every contract with two or more
    signatures.  A frame that has an ``address`` column already is returned
    as it is; ``observed`` may count the split lines on their way.
    """
    if "address" in contract_lines.columns:
        return contract_lines
    rows = keep_valid(observed(with_fields(contract_lines, csv_mode)), contract_rules())
    return rows.select(field(CON["address"]).alias("address"))


def contract_totals(tx_lines: DataFrame, contract_lines: DataFrame,
                    csv_mode: str = "quoted", bag: bool = False) -> DataFrame:
    """Value received by each contract: address, total_value (``tx_lines`` may be clustered by recipient).

    Set mode (default) gives one row per contract.  ``bag=True`` joins every
    contract line, so an address listed twice appears twice (the published
    behaviour).  Recipient totals are aggregated first (partial + final),
    then joined; contracts are de-duplicated by an aggregate on the same
    key, so both join sides arrive partitioned by address and the join adds
    no exchange; where one side is small, it is broadcast by its measured bytes.
    """
    contracts = contract_addresses(contract_lines, csv_mode)
    if not bag:
        contracts = contracts.distinct()
    return each_part(tx_lines, lambda tx: recipient_totals(tx).join(contracts, "address", "inner").select("address", "total_value"))


def top_contracts(tx_lines: DataFrame, contract_lines: DataFrame, k: int = 10,
                  csv_mode: str = "quoted", bag: bool = False) -> DataFrame:
    """The k contracts with the most value received: address, total_value."""
    return top_k(contract_totals(tx_lines, contract_lines, csv_mode, bag), "total_value", "address", k)


# --- C3 top miners ---------------------------------------------------------------


def miner_totals(block_lines: DataFrame) -> DataFrame:
    """Total block size per miner: miner, total_size."""
    rules = block_miner()
    rows = keep_valid(parsed_blocks(block_lines, needs(["miner", "size"], rules)), rules).select("miner", "size")
    return totals_by(rows, ["miner"], "size", "total_size")


def top_miners(block_lines: DataFrame, k: int = 10) -> DataFrame:
    return top_k(miner_totals(block_lines), "total_size", "miner", k)


# --- C4 storage overhead of hex columns ------------------------------------------


def overhead_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: bits stored per hex text column, and ``total_bits`` (summed row by row).

    One keyless aggregate; the columns, the total and their comparison are
    projections of this row, so the input is read once.
    """
    row_bits = sum((hex_bits(c) for c in columns[1:]), hex_bits(columns[0]))
    return df.agg(*[F.sum(hex_bits(c)).alias(c) for c in columns], F.sum(row_bits).alias("total_bits"))


def overhead_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bits stored per hex text column, long format: column, bits."""
    return overhead_sums(df, columns).select(*columns).unpivot([], list(columns), "column", "bits")


def overhead_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns' bits and the total, long format: column (or "total"), bits."""
    sums = overhead_sums(df, columns).withColumnRenamed("total_bits", "total")
    return sums.unpivot([], [*columns, "total"], "column", "bits")


def overhead_total(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total bits of the columns: total_bits, total_gb."""
    return overhead_sums(df, columns).select("total_bits", bits_to_gb("total_bits").alias("total_gb"))


def overhead_reconcile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum of the columns' bits against the total: sum_of_columns, total_bits, agrees."""
    return reconcile(overhead_sums(df, columns), columns, "total_bits")


def block_hex_frame(block_lines: DataFrame) -> DataFrame:
    """Valid block lines with the five hex columns named."""
    rules = block_any()
    rows = keep_valid(parsed_blocks(block_lines, needs(list(HEX_BLOCK_FIELDS), rules)), rules)
    return rows.select(*HEX_BLOCK_FIELDS)


# --- C5 monthly gas ------------------------------------------------------------------


def _to_contracts(rows: DataFrame, contracts: DataFrame | None) -> DataFrame:
    """Rows whose ``to_address`` is listed in ``contracts`` (address); all rows if None."""
    if contracts is None:
        return rows
    return rows.join(contracts.select(F.col("address").alias("to_address")).distinct(), "to_address", "left_semi")


def monthly_gas(tx_lines: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """Mean gas and mean gas price per month: month, avg_gas, avg_gas_price.

    With ``contracts`` (address, e.g. ``contract_addresses``), only
    transactions to a contract count.
    """
    rules = tx_gas()
    columns = ["month_no", "gas", "gas_price"] + ["to_address"] * (contracts is not None)
    rows = _to_contracts(keep_valid(parsed_transactions(tx_lines, needs(columns, rules)), rules), contracts)
    means = {"avg_gas": F.col("gas"), "avg_gas_price": F.col("gas_price")}
    return _labelled(means_by(rows, ["month_no"], means, None)).orderBy("month")


# --- C6 gas of top contracts against the overall mean ----------------------------


def global_mean_gas(tx_lines: DataFrame, lenient: bool = False, contracts: DataFrame | None = None) -> DataFrame:
    """One row: avg_gas over all transactions (``lenient`` = published count),
    or over those to one of ``contracts`` (address)."""
    rules = tx_gas_only(lenient)
    columns = ["gas"] + ["to_address"] * (contracts is not None)
    rows = _to_contracts(keep_valid(parsed_transactions(tx_lines, needs(columns, rules)), rules), contracts)
    return global_mean(rows, F.col("gas"), "avg_gas")


def gas_rows_in_set(tx_lines: DataFrame, addresses: DataFrame, top: bool = False) -> DataFrame:
    """Transactions to the listed addresses with a valid gas: address, gas.

    ``top=True`` says that ``addresses`` is a top-k list: its length is fixed,
    so it is broadcast and the membership test runs inside the scan stage.
    """
    rules = tx_gas_only()
    rows = keep_valid(parsed_transactions(tx_lines, needs(["to_address", "gas"], rules)), rules).select(
        F.col("to_address").alias("address"), "gas")
    keys = addresses.select("address")
    return rows.join(F.broadcast(keys) if top else keys, "address", "left_semi")


def recipient_mean_gas(tx_lines: DataFrame, addresses: DataFrame, top: bool = False) -> DataFrame:
    """Mean gas per listed address, largest first: address, avg_gas."""
    rows = gas_rows_in_set(tx_lines, addresses, top)
    means = means_by(rows, ["address"], {"avg_gas": F.col("gas")}, None)
    return means.orderBy(F.col("avg_gas").desc(), F.col("address"))


def recipient_profile(tx_lines: DataFrame, lenient: bool = False) -> DataFrame:
    """One aggregate per recipient holding everything the gas comparison needs.

    address, total_value / n_value (recipient-value rule), gas_total /
    n_gas (15 fields and a gas number: the per-address mean), and
    gas_total_all / n_gas_all (the overall-mean rule; equal to the former
    unless ``lenient``).  Contract creations keep their empty address.
    """
    parsed = parsed_transactions(tx_lines, needs(["to_address", "value", "gas"], tx_recipient(), tx_gas_only(),
                                                 tx_gas_only(lenient)))
    value_ok = passes(tx_recipient(), parsed)
    gas_ok = passes(tx_gas_only(), parsed)
    all_ok = passes(tx_gas_only(lenient), parsed) if lenient else gas_ok
    gas = F.col("gas")
    # every kept line has a recipient field; saying so keeps the plans of all readers alike
    rows = parsed.where((value_ok | all_ok) & F.col("to_address").isNotNull()).select(
        F.col("to_address").alias("address"),
        F.when(value_ok, F.col("value")).alias("value"),
        F.when(gas_ok, gas).alias("gas"),
        F.when(all_ok, gas).alias("gas_all"),
        value_ok.alias("value_ok"), gas_ok.alias("gas_ok"), all_ok.alias("all_ok"))
    return rows.groupBy("address").agg(
        F.try_sum("value").alias("total_value"), F.count_if("value_ok").alias("n_value"),
        F.try_sum("gas").alias("gas_total"), F.count_if("gas_ok").alias("n_gas"),
        F.try_sum("gas_all").alias("gas_total_all"), F.count_if("all_ok").alias("n_gas_all"))


def above_below_mean(tx_lines: DataFrame, contract_lines: DataFrame, k: int = 10,
                     csv_mode: str = "quoted", lenient: bool = False) -> DataFrame:
    """Top-k contracts' mean gas against the mean over all transactions.

    address, avg_gas, global_avg, side ("above" when ``>=``).

    One scan and one shuffle of the transactions: the grand total is summed
    from the per-recipient profile by a scalar subquery, which reads the same columns as
    the ranking does, so both reuse one exchange.
    """
    profiles = [recipient_profile(tx, lenient) for tx in parts(tx_lines)]
    profile = reduce(DataFrame.unionByName, profiles)
    columns = [c for c in profile.columns if c != "address"]
    sums = profile.agg(F.struct(*[F.try_sum(c).alias(c) for c in columns]).alias("sums")).scalar()
    overall = mean_of(sums.getField("gas_total_all"), sums.getField("n_gas_all"))
    # computed_once hides the contract rules from the optimizer, which would infer them for the
    # profile's side of the join and so scan the transactions once more for it
    contracts = computed_once(contract_addresses(contract_lines, csv_mode), F.col("address").alias("address")).distinct()
    # the overall rule is never the stricter one, so the last condition holds for all
    alike = (F.col("n_gas_all") >= F.col("n_gas")) & ((F.col("n_gas_all") == 0) | (F.col("gas_total_all").isNotNull() | F.col("gas_total").isNull()))
    listed = reduce(DataFrame.unionByName, [p.where(F.col("n_value") > 0).join(contracts, "address").where(alike) for p in profiles])
    top = top_k(listed, "total_value", "address", k)
    per = top.where(F.col("n_gas") > 0).select("address", mean_of(F.col("gas_total"), F.col("n_gas")).alias("avg_gas"))
    return above_below(per, "avg_gas", overall).orderBy(F.col("avg_gas").desc(), F.col("address"))


# --- C7 / C8 scams ------------------------------------------------------------------------


def scam_members(registry: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Listed addresses with their scam: address, id, category, scam_id."""
    return registry_addresses(registry_entries(registry), categories)


def _member_rows(tx_lines, registry: DataFrame, rules, values: list[str], key: str, dedupe: bool,
                 categories: Sequence[str] | None = None, salts: int = 0) -> DataFrame:
    """Valid transactions of listed addresses, one row per (transaction, key): address, values, key, copies.

    The one join of these questions: transactions meet each (address, key)
    once, with the number of copies the registry lists.  ``salts``: deal the rows of hot addresses
    over so many tasks, for a registry too large to be broadcast.
    """
    members = counted_members(scam_members(registry, categories), key, dedupe)

    def met(tx: DataFrame) -> DataFrame:
        rows = keep_valid(parsed_transactions(tx, needs(["to_address", *values], rules)), rules).select(
            F.col("to_address").alias("address"), *values)
        if not salts:
            return rows.join(members, "address")
        # equal rows are one with their number, so that a hot address spreads over the salts
        counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__times"))
        return salted_join(counted, members, "address", salts).withColumn("copies", F.col("copies") * F.col("__times")).drop("__times")

    return each_part(tx_lines, met)


def each_part(tx_lines, question: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A question whose answer is per recipient, over clustered transactions: the union over its parts."""
    return reduce(DataFrame.unionByName, [question(part) for part in parts(tx_lines)])


def scam_value_rows(tx_lines, registry: DataFrame, dedupe: bool = True, categories: Sequence[str] | None = None, salts: int = 0) -> DataFrame:
    """Valid dated transactions of listed addresses: address, month_no, value_wei, category, copies."""
    return _member_rows(tx_lines, registry, tx_recipient_time(), ["month_no", "value_wei"], "category", dedupe, categories, salts)


def scam_value_by_address(tx_lines: DataFrame, registry: DataFrame, dedupe: bool = True) -> DataFrame:
    """Value per listed address and scam: address, scam_id, total_value (whole-number text)."""
    rows = _member_rows(tx_lines, registry, tx_recipient(exact=True), ["value_wei"], "scam_id", dedupe)
    return whole_totals(rows, ["address", "scam_id"], "value_wei", "total_value", "copies")


def scam_id_totals(tx_lines: DataFrame, registry: DataFrame, dedupe: bool = True) -> DataFrame:
    """Value received per scam ("<id>_<category>"): scam_id, total_value."""
    rows = _member_rows(tx_lines, registry, tx_recipient(exact=True), ["value_wei"], "scam_id", dedupe)
    return whole_totals(rows, ["scam_id"], "value_wei", "total_value", "copies")


def top_scams(tx_lines: DataFrame, registry: DataFrame, k: int = 10, dedupe: bool = True) -> DataFrame:
    return top_k(scam_id_totals(tx_lines, registry, dedupe), "total_value", "scam_id", k)


def scam_category_rows(tx_lines: DataFrame, registry: DataFrame, dedupe: bool = True,
                       categories: Sequence[str] | None = None) -> DataFrame:
    """Monthly value per scam address and its category: address, month, category, value."""
    rows = _member_rows(tx_lines, registry, tx_recipient_time(), ["month_no", "value_wei"], "category", dedupe, categories)
    totals = whole_totals(rows, ["address", "month_no", "category"], "value_wei", "value", "copies")
    return totals.select("address", month_label("month_no").alias("month"), "category", "value")


def scam_monthly(tx_lines, registry: DataFrame, dedupe: bool = True,
                 categories: Sequence[str] | None = None, salts: int = 0) -> DataFrame:
    """Value received per month and scam category: month, category, total_value."""
    rows = scam_value_rows(tx_lines, registry, dedupe, categories, salts)
    return _labelled(whole_totals(rows, ["month_no", "category"], "value_wei", "total_value", "copies")).orderBy(
        "month", "category")


def scam_category_totals(monthly: DataFrame) -> DataFrame:
    """Grand total per category from a monthly series: category, total_value."""
    return whole_totals(monthly, ["category"], "total_value", "total_value")
