"""Ledger inputs derived, by Spark jobs, from the star-schema test tables.

The ledger export itself is not available, so each ledger table is a
deterministic projection of a given table; the same rules are written in
SQL for the DuckDB oracle (``plans/oracle.py``).  Everything is a
row-by-row projection of a scan, so it grows with the tables and runs in
parallel:

* transactions from ``lineitem``: recipient (contract view) ``p<partkey>``,
  or ``n<partkey>`` (no contract) when ``l_partkey % 4 = 0``, or (scam view)
  ``s<suppkey>``; empty on line number 7; value = cents of the extended
  price; gas = quantity; gas price = tax in cents; time = ship date, but the
  first of the quarter in ``GAP_YEAR``, so that year's other months are
  empty.  Lines are damaged by ``l_orderkey % 50``: 1 one field short, else
  one field as ``TX_DAMAGE`` says.
* contracts from every ``part``: no, one, or a quoted pair of signatures by
  ``p_size % 3``, and 20,000 quoted ones when ``p_partkey % 499 = 7``.
* blocks from ``orders``: miner ``c<custkey>`` (empty when
  ``o_orderkey % 40 = 0``), size = cents of the total price, or by
  ``BLOCK_DAMAGE``; one field short when ``% 40 = 2``; the five hex columns'
  lengths follow the key.
* registry from ``supplier`` with nation and region: one JSON document per
  supplier, keyed by its address; id = suppkey div 4, category = region
  name, addresses = the four addresses of that id (empty list for a
  negative account balance).  By ``s_suppkey % 50``: 1 the document is cut
  off, 2 no category, 3 no id, 4 no addresses, 5 the key stands twice, the
  first time with category "OLD".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.schemas import BLOCK_FIELDS, CONTRACT_FIELDS, TRANSACTION_FIELDS
from chaintally.session import app_id, staging_path
from chaintally.sources.lines import LINE, computed_once

# Fixed values of the binding (the oracle SQL states the same ones).
ONE_SIGNATURE = "0xa9059cbb"
TWO_SIGNATURES = '"0xa9059cbb,0x095ea7b3"'
TX_DAMAGE_MOD = 50
# remainder -> (field, text); a blank before {} keeps the field's own text
TX_DAMAGE = {
    2: ("value", "value"), 3: ("block_timestamp", "x"), 4: ("value", "5.7"), 5: ("gas", "g"),
    6: ("value", "9" * 78), 7: ("gas", "9" * 40), 8: ("block_timestamp", "9" * 20), 9: ("block_timestamp", "9" * 18),
    10: ("value", "  7"), 11: ("value", "+5"), 12: ("value", "1e18"), 13: ("value", "nan"), 14: ("value", "1_000"),
    15: ("block_timestamp", "1500000000000"), 16: ("gas", " 21000 "), 17: ("gas_price", "9" * 40),
    18: ("block_timestamp", "-99999999999999"),
}
BLOCK_DAMAGE_MOD = 40
BLOCK_DAMAGE = {1: "big", 3: "9" * 30, 4: " 77", 5: "+5", 6: "1_0"}
GAP_YEAR = 1997
LONG_CONTRACT_MOD, LONG_CONTRACT, LONG_SIGNATURES = 499, 7, 20_000
REGISTRY_DAMAGE_MOD = 50
SCAM_GROUP = 4
FILTER_CATEGORIES = ("AFRICA", "AMERICA", "ASIA")
ALL_CATEGORIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
HEX_DOCUMENT_COLUMNS = ("text", "lang", "source")
HEX_PAGE_COLUMNS = ("url", "html")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def _epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a local (NTZ) timestamp read as UTC."""
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def _with_gaps(ts: Column) -> Column:
    return F.when(F.year(ts) == GAP_YEAR, F.date_trunc("quarter", ts)).otherwise(ts)


# --- transactions -------------------------------------------------------------


def tx_columns(lineitem: DataFrame, recipients: str = "part") -> DataFrame:
    """Clean transaction fields as text (one row per lineitem)."""
    account = F.when(F.col("l_partkey") % 4 == 0, F.lit("n")).otherwise(F.lit("p"))
    key = {"part": F.concat(account, _s(F.col("l_partkey"))),
           "supplier": F.concat(F.lit("s"), _s(F.col("l_suppkey")))}[recipients]
    to = F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(key)
    # a column of its own, so that it is worked out once for the parts of the time
    return lineitem.withColumn("__shipped", _with_gaps(F.col("l_shipdate"))).select(
        F.col("l_orderkey").alias("__k"),
        F.concat(F.lit("0x"), _s(F.col("l_orderkey")), F.lit("_"), _s(F.col("l_linenumber"))).alias("hash"),
        _s(F.col("l_linenumber")).alias("nonce"),
        F.concat(F.lit("0xb"), _s(F.col("l_orderkey"))).alias("block_hash"),
        _s(F.col("l_orderkey")).alias("block_number"),
        _s(F.col("l_linenumber") - 1).alias("transaction_index"),
        F.concat(F.lit("f"), _s(F.col("l_orderkey"))).alias("from_address"),
        to.alias("to_address"),
        _s(_cents(F.col("l_extendedprice"))).alias("value"),
        _s(F.col("l_quantity").cast("bigint")).alias("gas"),
        _s(_cents(F.col("l_tax"))).alias("gas_price"),
        F.lit("0x").alias("input"),
        _s(_epoch_seconds(F.col("__shipped"))).alias("block_timestamp"),
        F.lit("").alias("max_fee_per_gas"),
        F.lit("").alias("max_priority_fee_per_gas"),
        F.lit("0").alias("transaction_type"),
    )


def tx_lines(spark: SparkSession, sf_dir: str, recipients: str = "part",
             damaged: bool = True) -> DataFrame:
    """Transaction export lines (``value``), with damaged lines by key."""
    cols = tx_columns(table(spark, sf_dir, "lineitem"), recipients)
    rule = F.col("__k") % TX_DAMAGE_MOD if damaged else F.lit(0)
    fields = []
    for name in TRANSACTION_FIELDS[:-1]:
        c = F.col(name)
        for k, (damaged_field, text) in TX_DAMAGE.items():
            c = F.when(rule == k, F.lit(text)).otherwise(c) if damaged_field == name else c
        fields.append(c)
    head = F.concat_ws(",", *fields)
    line = F.when(rule == 1, head).otherwise(F.concat(head, F.lit(","), F.col(TRANSACTION_FIELDS[-1])))
    return cols.select(line.alias("value"))


def header_line(spark: SparkSession, fields) -> DataFrame:
    return spark.range(1).select(F.lit(",".join(fields)).alias("value"))


def with_header(spark: SparkSession, lines: DataFrame, fields) -> DataFrame:
    """The lines plus one header line, as the export files start."""
    return header_line(spark, fields).unionByName(lines)


# --- contracts -------------------------------------------------------------------


def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    long = F.repeat(F.lit(f'"{ONE_SIGNATURE}",'), F.lit(LONG_SIGNATURES))
    sigs = (F.when(F.col("p_partkey") % LONG_CONTRACT_MOD == LONG_CONTRACT, long)
             .when(F.col("p_size") % 3 == 0, F.lit(""))
             .when(F.col("p_size") % 3 == 1, F.lit(ONE_SIGNATURE))
             .otherwise(F.lit(TWO_SIGNATURES)))
    line = F.concat_ws(",",
                       F.concat(F.lit("p"), _s(F.col("p_partkey"))),
                       F.concat(F.lit("0x6060"), _s(F.col("p_partkey"))),
                       sigs, F.when(F.col("p_partkey") % 2 == 0, F.lit("True")).otherwise(F.lit("False")),
                       F.lit("False"), _s(F.col("p_partkey")))
    return part.select(line.alias("value"))


# --- blocks -------------------------------------------------------------------------


def block_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rule = k % BLOCK_DAMAGE_MOD
    miner = F.when(rule == 0, F.lit("")).otherwise(F.concat(F.lit("c"), _s(F.col("o_custkey"))))
    size = _s(_cents(F.col("o_totalprice")))
    for k2, text in BLOCK_DAMAGE.items():
        size = F.when(rule == k2, F.lit(text)).otherwise(size)

    def digits(n: int, digit: str) -> Column:
        return F.concat(F.lit("0x"), F.repeat(F.lit(digit), (k % n).cast("int")))

    values = {
        "number": _s(k), "hash": F.concat(F.lit("0xh"), _s(k)),
        "parent_hash": F.concat(F.lit("0xh"), _s(k - 1)), "nonce": F.lit("0x0"),
        "sha3_uncles": digits(65, "a"), "logs_bloom": digits(513, "0"), "transactions_root": digits(7, "b"),
        "state_root": F.when(k % 11 == 0, F.lit("")).otherwise(digits(31, "c")), "receipts_root": digits(64, "d"), "miner": miner,
        "difficulty": _s(k), "total_difficulty": _s(k * 2), "size": size,
        "extra_data": F.lit("0x"), "gas_limit": F.lit("8000000"), "gas_used": F.lit("100"),
        "timestamp": _s(_epoch_seconds(F.col("o_orderdate"))), "transaction_count": F.lit("1"),
    }
    head = F.concat_ws(",", *[values[n] for n in BLOCK_FIELDS[:-1]])
    line = F.when(rule == 2, head).otherwise(F.concat(head, F.lit(",")))
    return orders.select(line.alias("value"))


# --- registry -------------------------------------------------------------------------


def registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry JSON document per supplier (``value``)."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                    .join(region, nation.n_regionkey == region.r_regionkey))
    group = F.floor(F.col("s_suppkey") / SCAM_GROUP).cast("bigint")
    members = F.transform(F.sequence(group * SCAM_GROUP, group * SCAM_GROUP + (SCAM_GROUP - 1)),
                          lambda x: F.concat(F.lit("s"), x.cast("string")))
    addresses = F.when(F.col("s_acctbal") < 0, F.array().cast("array<string>")).otherwise(members)
    rule = F.col("s_suppkey") % REGISTRY_DAMAGE_MOD
    # to_json leaves NULL members out
    entry = F.to_json(F.struct(F.when(rule != 3, group).alias("id"), F.when(rule != 2, F.col("r_name")).alias("category"),
                               F.when(rule != 4, addresses).alias("addresses")))
    old = F.to_json(F.struct(group.alias("id"), F.lit("OLD").alias("category"), addresses.alias("addresses")))
    key = F.concat(F.lit('"s'), _s(F.col("s_suppkey")), F.lit('":'))
    first = F.when(rule == 5, F.concat(key, old, F.lit(","))).otherwise(F.lit(""))
    doc = F.concat(F.lit('{"result":{'), first, key, entry, F.lit("}}"))
    return rows.select(F.when(rule == 1, F.substring(doc, 1, 25)).otherwise(doc).alias("value"))


# --- export files and lines ---------------------------------------------------------------------
#
# Questions over lines read them as they are derived, so no copy of a table is
# written for them.  Sources that take a path get the export as gzip text files, written once
# per session and table under the checkpoint root; a file is as large as what one task of the scan derives.

_STAGED: dict[tuple[str, str, str], str] = {}


def stage_text(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Write lines as lightly compressed gzip text files under the checkpoint root; return the folder."""
    path = staging_path(spark, name, kept=True)
    lines.write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return path


def ingested(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parsed Parquet table of a staged export file (tx_part, tx_supplier,
    blocks), ingested once per application: the text is parsed one time."""
    from chaintally.sources.parsed import ingest_parsed, parsed_blocks, parsed_transactions

    key = (app_id(spark), sf_dir.rstrip("/"), name + "@parquet")
    path = _STAGED.get(key)
    if path is None:
        lines = derived_lines(spark, sf_dir, name)
        parsed = parsed_blocks(lines) if name.startswith("blocks") else parsed_transactions(lines)
        path = staging_path(spark, name + "-parquet", kept=True)
        ingest_parsed(parsed, path)
        _STAGED[key] = path
    return spark.read.parquet(path)


def ingested_outcomes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Outcome counts of an ingested export file."""
    from chaintally.sources.parsed import read_outcomes

    ingested(spark, sf_dir, name)
    return read_outcomes(spark, _STAGED[(app_id(spark), sf_dir.rstrip("/"), name + "@parquet")])


def clustered(spark: SparkSession, sf_dir: str, name: str):
    """An ingested export file clustered by recipient, once per application."""
    from chaintally.sources.clustered import ingest_clustered, open_clustered

    key = (app_id(spark), sf_dir.rstrip("/"), name + "@clustered")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if key not in _STAGED:
        path = staging_path(spark, name + "-clustered", kept=True)
        _STAGED[key] = f"{buckets}:{path}"
        return ingest_clustered(ingested(spark, sf_dir, name), path, _table_name(path), buckets)
    buckets, path = _STAGED[key].split(":", 1)
    return open_clustered(spark, path, _table_name(path), int(buckets))


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_").replace(".", "_")


def export_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a staged export file (written on first use in this application)."""
    key = (app_id(spark), sf_dir.rstrip("/"), name)
    if key not in _STAGED:
        _STAGED[key] = stage_text(spark, _export(spark, sf_dir, name), name)
    return _STAGED[key]


def export_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The lines of a staged export file."""
    return spark.read.text(export_path(spark, sf_dir, name))


def derived_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same lines, derived where they are read: as the text source gives them (no NULL), each built once however many checks read it."""
    return computed_once(_export(spark, sf_dir, name), F.coalesce(F.col(LINE), F.lit("")).alias(LINE))


def _export(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lines of tx_part, tx_supplier, tx_part_header, contracts,
    contracts_header, blocks, blocks_header, registry."""
    builders = {
        "tx_part": lambda: tx_lines(spark, sf_dir, "part"),
        "tx_supplier": lambda: tx_lines(spark, sf_dir, "supplier"),
        "tx_part_header": lambda: with_header(spark, tx_lines(spark, sf_dir, "part"), TRANSACTION_FIELDS),
        "contracts": lambda: contract_lines(spark, sf_dir),
        "contracts_header": lambda: with_header(spark, contract_lines(spark, sf_dir), CONTRACT_FIELDS),
        "blocks": lambda: block_lines(spark, sf_dir),
        "blocks_header": lambda: with_header(spark, block_lines(spark, sf_dir), BLOCK_FIELDS),
        "registry": lambda: registry_lines(spark, sf_dir),
    }
    return builders[name]()
