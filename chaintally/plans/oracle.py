"""DuckDB SQL for every registered query, over the same star-schema tables.

Each statement rebuilds the ledger input with the binding rules of
``plans/binding.py`` (in SQL), splits lines with ``string_split`` and
checks fields with its own patterns and casts, so a match tests the
Spark plan end to end.  Sums are exact: wei totals are BIGNUM sums, written as
text; means are ``CAST(sum AS DOUBLE) / count`` of DECIMAL sums.
"""

from __future__ import annotations

from chaintally.plans.binding import (
    ALL_CATEGORIES,
    BLOCK_DAMAGE,
    BLOCK_DAMAGE_MOD,
    FILTER_CATEGORIES,
    GAP_YEAR,
    LONG_CONTRACT,
    LONG_CONTRACT_MOD,
    LONG_SIGNATURES,
    ONE_SIGNATURE,
    REGISTRY_DAMAGE_MOD,
    SCAM_GROUP,
    TWO_SIGNATURES,
    TX_DAMAGE,
    TX_DAMAGE_MOD,
)
from chaintally.schemas import BLOCK_FIELDS, CONTRACT_FIELDS, GB_PER_BIT, TRANSACTION_FIELDS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


AMOUNT = "DECIMAL(38,6)"
GAS = "DECIMAL(18,6)"
WEI = "DECIMAL(38,0)"

# Number text, written out here on its own: blanks around, a sign, digits, a fraction, an exponent.
_DIGITS = "[[:space:]]*[-+]?[0-9]+"
_WHOLE = _DIGITS + "[[:space:]]*"
_DECIMAL = _DIGITS + "([.][0-9]+)?([eE][-+]?[0-9]+)?[[:space:]]*"


def amount(x: str, kind: str = AMOUNT) -> str:
    """The parsed value, NULL for what is no number or does not fit."""
    return f"CASE WHEN regexp_full_match({x}, {_q(_DECIMAL)}) THEN TRY_CAST(trim({x}) AS {kind}) END"


def whole(x: str, kind: str = "BIGINT") -> str:
    return f"CASE WHEN regexp_full_match({x}, {_q(_WHOLE)}) THEN TRY_CAST(trim({x}) AS {kind}) END"


# The published jobs' conversions, written out on their own.
_GROUPED = "[0-9]+(_[0-9]+)*"
_LOOSE = f"[[:space:]]*[-+]?(({_GROUPED}[.]?({_GROUPED})?)|([.]{_GROUPED}))([eE][-+]?{_GROUPED})?[[:space:]]*"
_LOOSE_WHOLE = f"[[:space:]]*[-+]?{_GROUPED}[[:space:]]*"
_NOT_FINITE = "[[:space:]]*[-+]?(inf|infinity|nan)[[:space:]]*"


def loose(x: str, pattern: str, kind: str) -> str:
    """The value as the published jobs converted it, NULL for what they refused and for no finite number."""
    return f"CASE WHEN regexp_full_match({x}, {_q(pattern)}) THEN TRY_CAST(regexp_replace({x}, '[[:space:]_]', '', 'g') AS {kind}) END"


def not_finite(x: str) -> str:
    return f"coalesce(regexp_full_match(lower({x}), {_q(_NOT_FINITE)}), false)"


def num(x: str, kind: str = AMOUNT) -> str:
    return f"(({amount(x, kind)}) IS NOT NULL)"


def integer(x: str, kind: str = "BIGINT") -> str:
    return f"(({whole(x, kind)}) IS NOT NULL)"


def in_years(x: str) -> str:
    """Seconds of the years 1 to 9999."""
    return f"coalesce(({whole(x)}) BETWEEN epoch(TIMESTAMP '0001-01-01 00:00:00') AND epoch(TIMESTAMP '9999-12-31 23:59:59'), false)"


def is_whole(x: str) -> str:
    """A whole number of any length."""
    return f"coalesce(regexp_full_match({x}, {_q(_WHOLE)}), false)"


def bignum(x: str) -> str:
    """A whole number of any length as BIGNUM, NULL for what is none."""
    return f"CASE WHEN {is_whole(x)} THEN CAST(regexp_replace({x}, '[[:space:]+]', '', 'g') AS BIGNUM) END"


def nonempty(x: str) -> str:
    return f"coalesce(length({x}) > 0, false)"


def month_of(x: str) -> str:
    return f"strftime(make_timestamp(({whole(x)}) * 1000000), '%Y/%m')"


def damaged(rule: str, value: str, damage: dict) -> str:
    whens = " ".join(f"WHEN {k} THEN {_q(text)}" for k, text in damage.items())
    return f"CASE {rule} {whens} ELSE {value} END" if whens else value


def tx_damaged(name: str) -> str:
    return damaged("d", name, {k: text for k, (field, text) in TX_DAMAGE.items() if field == name})


def tx_cte(recipients: str = "part") -> str:
    to = {"part": "CASE WHEN l_partkey % 4 = 0 THEN 'n' ELSE 'p' END || l_partkey", "supplier": "'s' || l_suppkey"}[recipients]
    m = TX_DAMAGE_MOD
    return f"""
tx AS (
  SELECT l_orderkey % {m} AS d,
    '0x' || l_orderkey || '_' || l_linenumber AS hash,
    CAST(l_linenumber AS VARCHAR) AS nonce,
    '0xb' || l_orderkey AS block_hash,
    CAST(l_orderkey AS VARCHAR) AS block_number,
    CAST(l_linenumber - 1 AS VARCHAR) AS transaction_index,
    'f' || l_orderkey AS from_address,
    CASE WHEN l_linenumber = 7 THEN '' ELSE {to} END AS to_address,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS value,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS gas,
    CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) AS gas_price,
    '0x' AS input,
    CAST(CAST(epoch(CASE WHEN year(l_shipdate) = {GAP_YEAR} THEN date_trunc('quarter', l_shipdate) ELSE l_shipdate END) AS BIGINT)
         AS VARCHAR) AS block_timestamp,
    '' AS max_fee_per_gas, '' AS max_priority_fee_per_gas, '0' AS transaction_type
  FROM lineitem
),
txline AS (
  SELECT concat_ws(',', hash, nonce, block_hash, block_number, transaction_index, from_address,
           to_address,
           {tx_damaged('value')}, {tx_damaged('gas')}, {tx_damaged('gas_price')}, input, {tx_damaged('block_timestamp')},
           max_fee_per_gas, max_priority_fee_per_gas)
         || CASE WHEN d = 1 THEN '' ELSE ',' || transaction_type END AS line
  FROM tx
),
txf AS (SELECT line, string_split(line, ',') AS f FROM txline)"""


TX_HEADER = ",".join(TRANSACTION_FIELDS)
BLOCK_HEADER = ",".join(BLOCK_FIELDS)
CONTRACT_HEADER = ",".join(CONTRACT_FIELDS)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


# Transaction field positions (1-based lists in DuckDB).
F_TO, F_VALUE, F_GAS, F_PRICE, F_TS = "f[7]", "f[8]", "f[9]", "f[10]", "f[12]"

TIME = f"{integer(F_TS)} AND {in_years(F_TS)}"
V1 = f"len(f) = 15 AND {num(F_VALUE)} AND {TIME}"
V2 = f"len(f) = 15 AND {nonempty(F_TO)} AND {num(F_VALUE)}"
V2X = f"len(f) = 15 AND {nonempty(F_TO)} AND {is_whole(F_VALUE)}"
V3 = f"{V2X} AND {TIME}"
V4 = f"len(f) = 15 AND {num(F_GAS, GAS)} AND {num(F_PRICE)} AND {TIME}"
V5_STRICT = f"len(f) = 15 AND {num(F_GAS, GAS)}"
V5_LENIENT = f"(len(f) = 15 OR (len(f) > 6 AND {nonempty(F_TO)})) AND {num(F_GAS, GAS)}"


def reason_case(rules: list[tuple[str, str]]) -> str:
    """CASE giving the first failing rule's reason, else 'ok'."""
    whens = " ".join(f"WHEN NOT ({cond}) THEN {_q(reason)}" for reason, cond in rules)
    return f"CASE {whens} ELSE 'ok' END"


TIME_RULES = [("integer:block_timestamp", integer(F_TS)), ("range:block_timestamp", in_years(F_TS))]

TX_RULES = {
    "value_time": [("arity", "len(f) = 15"), ("number:value", num(F_VALUE)),
                   *TIME_RULES],
    "recipient": [("arity", "len(f) = 15"), ("empty:to_address", nonempty(F_TO)),
                  ("number:value", num(F_VALUE))],
    "recipient_time": [("arity", "len(f) = 15"), ("empty:to_address", nonempty(F_TO)),
                       ("integer:value", is_whole(F_VALUE)), *TIME_RULES],
    "gas": [("arity", "len(f) = 15"), ("number:gas", num(F_GAS, GAS)), ("number:gas_price", num(F_PRICE)),
            *TIME_RULES],
}


def contract_cte() -> str:
    return f"""
conline AS (
  SELECT concat_ws(',', 'p' || p_partkey, '0x6060' || p_partkey,
           CASE WHEN p_partkey % {LONG_CONTRACT_MOD} = {LONG_CONTRACT} THEN repeat({_q(f'"{ONE_SIGNATURE}",')}, {LONG_SIGNATURES})
                WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN {_q(ONE_SIGNATURE)} ELSE {_q(TWO_SIGNATURES)} END,
           CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END, 'False', CAST(p_partkey AS VARCHAR)) AS line
  FROM part
),
conall AS (
  SELECT line FROM conline UNION ALL SELECT {_q(CONTRACT_HEADER)}
)"""


def contract_fields(naive: bool) -> str:
    """Fields of a contract line; for a quoted split, what is quoted is put aside first (its commas as spaces)."""
    return "string_split(line, ',')" if naive else """string_split(regexp_replace(line, '"[^"]*"', 'quoted', 'g'), ',')"""


def contract_rules_sql(naive: bool) -> list[tuple[str, str]]:
    f = contract_fields(naive)
    return [("arity", f"len({f}) = 6"), ("empty:address", nonempty(f"{f}[1]")),
            ("header", f"coalesce({f}[1] <> 'address', true)")]


def block_cte() -> str:
    m = BLOCK_DAMAGE_MOD
    head = ", ".join([
        "CAST(o_orderkey AS VARCHAR)", "'0xh' || o_orderkey", "'0xh' || (o_orderkey - 1)", "'0x0'",
        "'0x' || repeat('a', o_orderkey % 65)", "'0x' || repeat('0', o_orderkey % 513)", "'0x' || repeat('b', o_orderkey % 7)",
        "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '0x' || repeat('c', o_orderkey % 31) END", "'0x' || repeat('d', o_orderkey % 64)",
        f"CASE WHEN o_orderkey % {m} = 0 THEN '' ELSE 'c' || o_custkey END",
        "CAST(o_orderkey AS VARCHAR)", "CAST(o_orderkey * 2 AS VARCHAR)",
        damaged(f"o_orderkey % {m}", "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)", BLOCK_DAMAGE),
        "'0x'", "'8000000'", "'100'", "CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR)", "'1'",
    ])
    return f"""
blkline AS (
  SELECT concat_ws(',', {head}) || CASE WHEN o_orderkey % {m} = 2 THEN '' ELSE ',' END AS line
  FROM orders
),
blkall AS (SELECT line FROM blkline UNION ALL SELECT {_q(BLOCK_HEADER)}),
blkf AS (SELECT string_split(line, ',') AS f FROM blkall)"""


BLOCK_MINER_RULES = [("arity", "len(f) = 19"), ("empty:miner", nonempty("f[10]")),
                     ("integer:size", integer("f[13]"))]
BLOCK_ANY_RULES = [("arity", "len(f) = 19"), ("header", "coalesce(f[1] <> 'number', true)")]


def registry_cte() -> str:
    g, m = SCAM_GROUP, REGISTRY_DAMAGE_MOD
    return f"""
alldocs AS (
  SELECT 's' || s_suppkey AS entry_address, CASE WHEN s_suppkey % {m} <> 3 THEN CAST(s_suppkey // {g} AS VARCHAR) END AS id,
         CASE WHEN s_suppkey % {m} <> 2 THEN r_name END AS category,
         s_suppkey // {g} AS grp, s_suppkey % {m} = 1 AS cut,
         CASE WHEN s_suppkey % {m} = 4 THEN NULL WHEN s_acctbal < 0 THEN 0 ELSE {g} END AS n_listed
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
entries AS (SELECT * FROM alldocs WHERE NOT cut AND id IS NOT NULL AND category IS NOT NULL),
members AS (
  SELECT 's' || x AS address, id, category, id || '_' || category AS scam_id
  FROM (SELECT id, category, unnest(range(grp * {g}, grp * {g} + {g})) AS x FROM entries WHERE n_listed > 0)
)"""


def _in(values) -> str:
    return ", ".join(_q(v) for v in values)


def scam_totals_sql(dedupe: bool) -> str:
    mem = "SELECT DISTINCT address, scam_id FROM members" if dedupe else "SELECT address, scam_id FROM members"
    return with_(tx_cte("supplier"), registry_cte(), f"""
tot AS (SELECT f[7] AS address, sum({bignum('f[8]')}) AS total_value FROM txf WHERE {V2X} GROUP BY 1),
mem AS ({mem})""") + """
SELECT scam_id, CAST(sum(total_value) AS VARCHAR) AS total_value
FROM tot JOIN mem USING (address) GROUP BY scam_id"""


def scam_monthly_sql(dedupe: bool, categories=None) -> str:
    where = f"WHERE category IN ({_in(categories)})" if categories else ""
    mem = (f"SELECT DISTINCT address, category FROM members {where}" if dedupe
           else f"SELECT address, category FROM members {where}")
    return with_(tx_cte("supplier"), registry_cte(), f"""
rows AS (SELECT f[7] AS address, {month_of(F_TS)} AS month, {bignum('f[8]')} AS value
         FROM txf WHERE {V3}),
mem AS ({mem})""") + """
SELECT month, category, CAST(sum(value) AS VARCHAR) AS total_value
FROM rows JOIN mem USING (address) GROUP BY month, category"""


# Whole-number text in the order of numbers.
EXACT = "CAST(total_value AS BIGNUM)"


def top(sql: str, measure: str, key: str, k: int = 10) -> str:
    return f"SELECT * FROM ({sql}) ORDER BY {measure} DESC, {key} LIMIT {k}"


def contract_totals_sql(naive: bool = False, bag: bool = False) -> str:
    ok = " AND ".join(f"({c})" for _, c in contract_rules_sql(naive))
    cons = f"SELECT {contract_fields(naive)}[1] AS address FROM conall WHERE {ok}"
    if not bag:
        cons = f"SELECT DISTINCT address FROM ({cons})"
    return with_(tx_cte("part"), contract_cte(), f"""
tot AS (SELECT f[7] AS address, sum({amount('f[8]')}) AS total_value FROM txf WHERE {V2} GROUP BY 1),
cons AS ({cons})""") + """
SELECT address, CAST(total_value AS DOUBLE) AS total_value FROM tot JOIN cons USING (address)"""


def reason_counts_sql(ctes: list[str], source: str, rules) -> str:
    return with_(*ctes) + f"SELECT {reason_case(rules)} AS reason, count(*) AS n FROM {source} GROUP BY 1"


def hex_bits_sql(c: str) -> str:
    return f"CAST((length(coalesce({c}, '')) - 2) * 4 AS BIGINT)"


def _top10_cte() -> str:
    return f"top10 AS ({top(contract_totals_sql(), 'total_value', 'address')})"


def _gas_in_set_sql(select: str, group: str) -> str:
    # contract_totals_sql carries its own WITH; nest it as a derived table
    return (with_(tx_cte("part"), _top10_cte())
            + f"SELECT {select} FROM txf WHERE {V5_STRICT} AND f[7] IN (SELECT address FROM top10) {group}")


def overhead_columns_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", sum({hex_bits_sql(c)}) AS bits FROM documents" for c in ("text", "lang", "source")]
    parts += [f"SELECT '{c}' AS \"column\", sum({hex_bits_sql(c)}) AS bits FROM pages" for c in ("url", "html")]
    return " UNION ALL ".join(f"({p})" for p in parts)


def overhead_total_sql() -> str:
    doc = " + ".join(hex_bits_sql(c) for c in ("text", "lang", "source"))
    page = " + ".join(hex_bits_sql(c) for c in ("url", "html"))
    return (f"SELECT CAST(t AS BIGINT) AS total_bits, CAST(t AS DOUBLE) * {GB_PER_BIT} AS total_gb FROM ("
            f"SELECT (SELECT sum({doc}) FROM documents) + (SELECT sum({page}) FROM pages) AS t)")


def oracle_queries() -> dict[str, str]:
    txp = tx_cte("part")
    value_time = TX_RULES["value_time"]
    q: dict[str, str] = {}

    q["monthly_value"] = with_(txp) + f"""
SELECT {month_of(F_TS)} AS month, count(*) AS n,
       CAST(sum({amount(F_VALUE)}) AS DOUBLE) / count(*) AS avg_value
FROM txf WHERE {V1} GROUP BY 1"""

    q["month_key"] = with_(txp) + f"""
SELECT hash, CAST(block_timestamp AS BIGINT) AS block_timestamp, {month_of('block_timestamp')} AS month FROM tx"""

    q["scan_lines"] = with_(txp) + f"SELECT line AS value FROM txline UNION ALL SELECT {_q(TX_HEADER)}"
    q["filter_arity"] = with_(txp) + "SELECT line AS value FROM txf WHERE len(f) = 15"
    q["filter_nonempty"] = with_(txp) + f"SELECT line AS value FROM txf WHERE {nonempty(F_TO)}"
    q["filter_numeric"] = with_(txp) + f"SELECT line AS value FROM txf WHERE {num(F_VALUE)}"
    loose_value, loose_time = loose(F_VALUE, _LOOSE, "DOUBLE"), loose(F_TS, _LOOSE_WHOLE, "BIGINT")
    loose_num = f"(({loose_value}) IS NOT NULL OR {not_finite(F_VALUE)})"
    loose_rules = [("arity", "len(f) = 15"), ("number:value", loose_num), ("integer:block_timestamp", f"(({loose_time}) IS NOT NULL)"),
                   ("range:block_timestamp", in_years(F_TS))]
    q["filter_numeric_compat"] = with_(txp) + f"SELECT line AS value FROM txf WHERE {loose_num}"
    q["valid_tx_value_time_compat"] = reason_counts_sql([txp], "txf", loose_rules)
    q["project_fields_compat"] = with_(txp) + f"""
SELECT f[1] AS hash, CASE WHEN {not_finite(F_VALUE)} THEN CASE WHEN contains(lower({F_VALUE}), 'nan') THEN 'nan' ELSE 'infinite' END ELSE 'finite' END AS kind,
       {loose_value} AS value, {loose_time} AS block_timestamp
FROM txf WHERE {" AND ".join(c for _, c in loose_rules)}"""
    q["filter_integer"] = with_(txp) + f"SELECT line AS value FROM txf WHERE {integer(F_TS)}"
    q["filter_header"] = (with_(txp, f"allf AS (SELECT line, string_split(line, ',') AS f FROM txline UNION ALL SELECT {_q(TX_HEADER)}, string_split({_q(TX_HEADER)}, ','))")
                          + "SELECT line AS value FROM allf WHERE coalesce(f[1] <> 'hash', true)")
    q["filter_lenient"] = with_(txp) + f"""
SELECT count(*) AS n, CAST(sum({amount(F_GAS, GAS)}) AS DOUBLE) / count(*) AS avg_gas
FROM txf WHERE {V5_LENIENT}"""
    q["project_fields"] = with_(txp) + f"""
SELECT f[1] AS hash, f[7] AS to_address, {amount(F_VALUE, "DOUBLE")} AS value,
       {amount(F_GAS, "DOUBLE")} AS gas, {whole(F_TS)} AS block_timestamp
FROM txf WHERE {V1}"""

    q["valid_tx_value_time"] = reason_counts_sql([txp], "txf", value_time)
    q["valid_tx_recipient"] = reason_counts_sql([txp], "txf", TX_RULES["recipient"])
    q["valid_tx_recipient_time"] = reason_counts_sql([tx_cte("supplier")], "txf", TX_RULES["recipient_time"])
    q["valid_tx_gas"] = reason_counts_sql([txp], "txf", TX_RULES["gas"])
    q["valid_contract"] = reason_counts_sql([contract_cte()], "conall", contract_rules_sql(False))
    q["valid_contract_compat"] = reason_counts_sql([contract_cte()], "conall", contract_rules_sql(True))
    q["valid_block_miner"] = reason_counts_sql([block_cte()], "blkf", BLOCK_MINER_RULES)
    q["valid_block_any"] = reason_counts_sql([block_cte()], "blkf", BLOCK_ANY_RULES)

    hdr_rules = [("arity", "len(f) = 15"), ("header", "coalesce(f[1] <> 'hash', true)")] + value_time[1:]
    q["quality_report"] = with_(txp, f"allf AS (SELECT f FROM txf UNION ALL SELECT string_split({_q(TX_HEADER)}, ','))",
                                f"c AS (SELECT {reason_case(hdr_rules)} AS reason, count(*) AS n FROM allf GROUP BY 1)") + """
SELECT reason, n, CAST(sum(n) OVER () AS BIGINT) AS lines,
       CAST(sum(CASE WHEN reason = 'ok' THEN n ELSE 0 END) OVER () AS BIGINT) AS kept,
       CAST(sum(n) OVER () - sum(CASE WHEN reason = 'ok' THEN n ELSE 0 END) OVER () AS BIGINT) AS dropped FROM c"""

    def report(ctes, source, rules):
        return with_(*ctes, f"c AS (SELECT {reason_case(rules)} AS reason, count(*) AS n FROM {source} GROUP BY 1)") + """
SELECT reason, n, CAST(sum(n) OVER () AS BIGINT) AS lines,
       CAST(sum(CASE WHEN reason = 'ok' THEN n ELSE 0 END) OVER () AS BIGINT) AS kept,
       CAST(sum(n) OVER () - sum(CASE WHEN reason = 'ok' THEN n ELSE 0 END) OVER () AS BIGINT) AS dropped FROM c"""
    q["quality_report_contracts"] = report([contract_cte()], "conall", contract_rules_sql(False))
    q["quality_report_contracts_compat"] = report([contract_cte()], "conall", contract_rules_sql(True))
    q["quality_report_blocks"] = report([block_cte()], "blkf", BLOCK_MINER_RULES)

    # typed sources: every field must parse; the damaged lines all fail one
    typed_ok = (f"len(f) = 15 AND f[1] <> 'hash' AND {integer(F_VALUE, WEI)} AND {integer(F_GAS)} "
                f"AND {TIME} AND {integer(F_PRICE, WEI)}")
    q["scan_transactions"] = with_(txp) + f"""
SELECT f[1] AS hash, nullif(f[7], '') AS to_address, CAST({whole(F_VALUE, WEI)} AS BIGINT) AS value,
       {whole(F_GAS)} AS gas, {whole(F_TS)} AS block_timestamp
FROM txf WHERE {typed_ok}"""
    q["scan_blocks"] = with_(block_cte()) + """
SELECT CAST(f[1] AS BIGINT) AS number, nullif(f[10], '') AS miner, CAST(trim(f[13]) AS BIGINT) AS size,
       CAST(f[17] AS BIGINT) AS timestamp
FROM blkf WHERE len(f) = 19 AND f[1] <> 'number' AND """ + integer("f[13]")
    for key, naive in (("scan_contracts", False), ("scan_contracts_compat", True)):
        f = contract_fields(naive)
        ok = " AND ".join(f"({c})" for _, c in contract_rules_sql(naive))
        # what is quoted is a signature list: its commas are counted in the line itself
        n_signatures = (f"CASE WHEN {f}[3] = '' THEN 0 WHEN {f}[3] = 'quoted' "
                        """THEN len(string_split(regexp_extract(line, '"([^"]*)"', 1), ',')) ELSE 1 END""")
        q[key] = with_(contract_cte()) + f"""
SELECT {f}[1] AS address, CAST({n_signatures} AS INTEGER) AS n_signatures, {f}[4] = 'True' AS is_erc20
FROM conall WHERE {ok}"""

    reg = registry_cte()
    q["scan_registry"] = with_(reg) + """
SELECT entry_address, id, category,
       CAST(n_listed AS INTEGER) AS n_addresses FROM entries"""
    q["registry_entries"] = q["scan_registry"]
    q["registry_ids"] = with_(reg) + "SELECT entry_address, id || '_' || category AS scam_id FROM entries"
    q["registry_addresses"] = with_(reg) + "SELECT address, id, category, scam_id FROM members"
    q["registry_counts"] = with_(reg) + "SELECT category, count(*) AS n_addresses FROM members GROUP BY 1"
    q["filter_category"] = with_(reg) + f"SELECT address, category FROM members WHERE category IN ({_in(FILTER_CATEGORIES)})"

    q["recipient_totals"] = with_(txp) + f"""
SELECT f[7] AS address, CAST(sum({amount(F_VALUE)}) AS DOUBLE) AS total_value
FROM txf WHERE {V2} GROUP BY 1"""
    q["contract_totals"] = contract_totals_sql()
    q["top_contracts"] = top(contract_totals_sql(), "total_value", "address")
    q["top_contracts_compat"] = top(contract_totals_sql(naive=True, bag=True), "total_value", "address")

    q["quality_report_registry"] = with_(reg, """
c AS (SELECT CASE WHEN cut THEN 'json' WHEN id IS NULL THEN 'id' WHEN category IS NULL THEN 'category' ELSE 'ok' END AS reason,
             count(*) AS n FROM alldocs GROUP BY 1)""") + """
SELECT reason, n, CAST(sum(n) OVER () AS BIGINT) AS lines,
       CAST(sum(CASE WHEN reason = 'ok' THEN n ELSE 0 END) OVER () AS BIGINT) AS kept,
       CAST(sum(n) OVER () - sum(CASE WHEN reason = 'ok' THEN n ELSE 0 END) OVER () AS BIGINT) AS dropped FROM c"""

    miner = with_(block_cte()) + f"""
SELECT f[10] AS miner, sum(CAST(trim(f[13]) AS BIGINT)) AS total_size FROM blkf
WHERE {" AND ".join(f"({c})" for _, c in BLOCK_MINER_RULES)} GROUP BY 1"""
    q["miner_totals"] = miner.replace("sum(CAST(trim(f[13]) AS BIGINT))", "CAST(sum(CAST(trim(f[13]) AS BIGINT)) AS BIGINT)")
    q["top_miners"] = top(q["miner_totals"], "total_size", "miner")

    q["hex_bits"] = ("SELECT doc_id, " + ", ".join(f"{hex_bits_sql(c)} AS {c}_bits" for c in ("text", "lang", "source"))
                     + " FROM documents")
    q["overhead_columns"] = f"SELECT \"column\", CAST(bits AS BIGINT) AS bits FROM ({overhead_columns_sql()})"
    q["overhead_total"] = overhead_total_sql()
    q["reconcile_total"] = (f"SELECT CAST(a AS BIGINT) AS sum_of_columns, CAST(b AS BIGINT) AS total_bits, a = b AS agrees FROM ("
                            f"SELECT (SELECT sum(bits) FROM ({overhead_columns_sql()})) AS a, "
                            f"(SELECT total_bits FROM ({overhead_total_sql()})) AS b)")

    blocks = with_(block_cte(), f"hexed AS (SELECT f FROM blkf WHERE {' AND '.join(f'({c})' for _, c in BLOCK_ANY_RULES)})")
    names = {5: "sha3_uncles", 6: "logs_bloom", 7: "transactions_root", 8: "state_root", 9: "receipts_root"}
    q["block_overhead_columns"] = blocks + " UNION ALL ".join(
        f"(SELECT '{n}' AS \"column\", CAST(sum({hex_bits_sql(f'f[{i}]')}) AS BIGINT) AS bits FROM hexed)" for i, n in names.items())
    row = " + ".join(hex_bits_sql(f"f[{i}]") for i in names)
    q["block_overhead_total"] = blocks + (f"SELECT CAST(sum({row}) AS BIGINT) AS total_bits, "
                                          f"CAST(sum({row}) AS DOUBLE) * {GB_PER_BIT} AS total_gb FROM hexed")
    columns = " + ".join(f"sum({hex_bits_sql(f'f[{i}]')})" for i in names)
    q["block_reconcile"] = blocks + (f"SELECT CAST({columns} AS BIGINT) AS sum_of_columns, CAST(sum({row}) AS BIGINT) AS total_bits, "
                                     f"{columns} = sum({row}) AS agrees FROM hexed")

    q["monthly_gas"] = with_(txp) + f"""
SELECT {month_of(F_TS)} AS month,
       CAST(sum({amount(F_GAS, GAS)}) AS DOUBLE) / count(*) AS avg_gas,
       CAST(sum({amount(F_PRICE)}) AS DOUBLE) / count(*) AS avg_gas_price
FROM txf WHERE {V4} GROUP BY 1"""
    q["global_mean_gas"] = with_(txp) + f"""
SELECT CAST(sum({amount(F_GAS, GAS)}) AS DOUBLE) / count(*) AS avg_gas FROM txf WHERE {V5_STRICT}"""
    q["global_mean_gas_compat"] = with_(txp) + f"""
SELECT CAST(sum({amount(F_GAS, GAS)}) AS DOUBLE) / count(*) AS avg_gas FROM txf WHERE {V5_LENIENT}"""
    ok = " AND ".join(f"({c})" for _, c in contract_rules_sql(False))
    listed = f"f[7] IN (SELECT {contract_fields(False)}[1] FROM conall WHERE {ok})"
    for key in ("monthly_gas", "global_mean_gas"):
        q[key + "_contracts"] = q[key].replace(with_(txp), with_(txp, contract_cte())).replace("FROM txf WHERE", f"FROM txf WHERE {listed} AND")
    q["contract_totals_compat"] = contract_totals_sql(naive=True, bag=True)
    top_naive = top(contract_totals_sql(naive=True), "total_value", "address")
    q["above_below_mean_compat"] = (
        f"WITH per AS ({with_(txp, f'top10 AS ({top_naive})')}"
        f"SELECT f[7] AS address, CAST(sum({amount(F_GAS, GAS)}) AS DOUBLE) / count(*) AS avg_gas "
        f"FROM txf WHERE {V5_STRICT} AND f[7] IN (SELECT address FROM top10) GROUP BY 1), "
        f"g AS ({q['global_mean_gas_compat']})\n"
        "SELECT address, avg_gas, (SELECT avg_gas FROM g) AS global_avg, "
        "CASE WHEN avg_gas >= (SELECT avg_gas FROM g) THEN 'above' ELSE 'below' END AS side FROM per")
    q["filter_in_set"] = _gas_in_set_sql("f[7] AS address, count(*) AS n", "GROUP BY 1")
    q["recipient_mean_gas"] = _gas_in_set_sql(
        f"f[7] AS address, CAST(sum({amount(F_GAS, GAS)}) AS DOUBLE) / count(*) AS avg_gas", "GROUP BY 1")
    q["above_below_mean"] = (
        f"WITH per AS ({q['recipient_mean_gas']}), g AS ({q['global_mean_gas']})\n"
        "SELECT address, avg_gas, (SELECT avg_gas FROM g) AS global_avg, "
        "CASE WHEN avg_gas >= (SELECT avg_gas FROM g) THEN 'above' ELSE 'below' END AS side FROM per")

    pairs = f"SELECT row_number() OVER (ORDER BY total_value DESC, address) AS rank, address, total_value FROM ({q['top_contracts']})"
    q["read_pair_result"] = f"SELECT CAST(rank AS INTEGER) AS rank, address AS key, total_value FROM ({pairs})"
    q["sink_roundtrip"] = q["top_contracts"]
    q["sink_full_result"] = q["saved_series"] = q["monthly_value"]
    q["trim_chars"] = f"SELECT CAST(rank AS INTEGER) AS rank, address AS key FROM ({pairs})"
    q["peek_rows"] = with_(txp) + """
SELECT hash, CAST(block_number AS BIGINT) AS block_number, CAST(transaction_index AS BIGINT) AS transaction_index
FROM tx ORDER BY CAST(block_number AS BIGINT), CAST(transaction_index AS BIGINT) LIMIT 5"""
    q["exact_amount"] = with_(txp) + """
SELECT l_orderkey % 10 AS digit,
       CAST(sum(CAST(CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE '' END || value || repeat('7', CAST(l_orderkey % 70 AS INTEGER)) AS BIGNUM)) AS VARCHAR)
         AS total_wei
FROM (SELECT CAST(block_number AS BIGINT) AS l_orderkey, value FROM tx) GROUP BY 1"""
    q["recipient_totals_exact"] = with_(txp) + f"""
SELECT f[7] AS address, CAST(sum({bignum(F_VALUE)}) AS VARCHAR) AS total_value FROM txf WHERE {V2X} GROUP BY 1"""
    q["top_recipients_exact"] = top(q["recipient_totals_exact"], EXACT, "address")

    q["scam_id_join"] = with_(tx_cte("supplier"), registry_cte(), f"""
tot AS (SELECT f[7] AS address, sum({bignum('f[8]')}) AS total_value FROM txf WHERE {V2X} GROUP BY 1)""") + """
SELECT address, scam_id, CAST(total_value AS VARCHAR) AS total_value
FROM tot JOIN (SELECT DISTINCT address, scam_id FROM members) m USING (address)"""
    q["scam_id_totals"] = scam_totals_sql(True)
    q["scam_id_totals_compat"] = scam_totals_sql(False)
    q["top_scams"] = top(scam_totals_sql(True), EXACT, "scam_id")
    q["top_scams_compat"] = top(scam_totals_sql(False), EXACT, "scam_id")
    q["best_scam"] = top(scam_totals_sql(True), EXACT, "scam_id", 1)
    q["best_scam_compat"] = top(scam_totals_sql(False), EXACT, "scam_id", 1)

    q["scam_category_join"] = with_(tx_cte("supplier"), registry_cte(), f"""
rows AS (SELECT f[7] AS address, {month_of(F_TS)} AS month, {bignum('f[8]')} AS value
         FROM txf WHERE {V3})""") + """
SELECT address, month, category, CAST(sum(value) AS VARCHAR) AS value
FROM rows JOIN (SELECT DISTINCT address, category FROM members) m USING (address)
GROUP BY address, month, category"""
    q["scam_monthly"] = scam_monthly_sql(True)
    q["scam_monthly_compat"] = scam_monthly_sql(False)
    q["scam_category_totals"] = (f"SELECT category, CAST(sum(CAST(total_value AS BIGNUM)) AS VARCHAR) AS total_value "
                                 f"FROM ({scam_monthly_sql(True)}) GROUP BY 1")
    series = scam_monthly_sql(True)
    q["zero_filled_series"] = f"""
WITH s AS ({series}),
bounds AS (SELECT min(strptime(month || '/01', '%Y/%m/%d')) AS lo, max(strptime(month || '/01', '%Y/%m/%d')) AS hi FROM s),
axis AS (SELECT c.category, strftime(d, '%Y/%m') AS month
         FROM (SELECT DISTINCT category FROM s) c, bounds, LATERAL (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d))
SELECT a.month, a.category, coalesce(s.total_value, '0') AS total_value
FROM axis a LEFT JOIN s ON a.category = s.category AND a.month = s.month"""
    cols = ", ".join(f"max(CASE WHEN category = {_q(c)} THEN total_value END) AS \"{c}\"" for c in ALL_CATEGORIES)
    q["chart_series"] = f"SELECT month, {cols} FROM ({q['zero_filled_series']}) GROUP BY month"
    q["monthly_value_stream"] = q["monthly_value"]
    q["ingest_transactions"] = with_(txp) + f"""
SELECT f[1] AS hash, f[7] AS to_address, CAST({amount(F_VALUE)} AS DOUBLE) AS value,
       CASE WHEN {TIME} THEN {month_of(F_TS)} END AS month,
       len(f) = 15 AS ok_arity, {num(F_VALUE)} AS ok_number_value, {integer(F_TS)} AS ok_integer_block_timestamp
FROM txf"""
    for key in ("monthly_value", "monthly_gas", "top_contracts", "above_below_mean", "top_miners",
                "top_scams", "scam_monthly", "quality_report"):
        q[key + "_columnar"] = q[key]
    for key in ("monthly_value", "monthly_gas", "scam_monthly"):
        q[key + "_incremental"] = q[key]
    for key in ("top_contracts", "above_below_mean", "top_scams"):
        q[key + "_clustered"] = q[key]
    q["scam_monthly_salted"] = q["scam_monthly"]
    q["compare_saved"] = f"""
-- the limit keeps the conditions on months from being asked of lines that have none
WITH s AS (SELECT * FROM ({q["monthly_value"]}) LIMIT 1000000), m AS (SELECT month, substr(month, 6, 2) AS mm FROM s)
SELECT month, 'extra' AS kind, CAST(NULL AS VARCHAR) AS "column" FROM m WHERE mm IN ('02', '07')
UNION ALL SELECT 'x' || month, 'missing', NULL FROM m WHERE mm = '07'
UNION ALL SELECT month, 'different', 'avg_value' FROM m WHERE mm = '03'
UNION ALL SELECT month, 'different', 'n' FROM m WHERE mm IN ('05', '06')"""
    return q
