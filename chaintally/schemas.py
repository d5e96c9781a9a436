"""Field legends, schemas and fixed values of the ledger export.

The export is four files: transactions, blocks and contracts as comma
separated text with a header line, and a scam registry as one JSON
document.  Fields are known by position in the raw lines, so every
legend below is the order of the fields in the export header.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the export's layout and the published
# analysis, so they are stated here as plain text, in export order.
# ---------------------------------------------------------------------------

TRANSACTION_FIELDS = (
    "hash", "nonce", "block_hash", "block_number", "transaction_index",
    "from_address", "to_address", "value", "gas", "gas_price", "input",
    "block_timestamp", "max_fee_per_gas", "max_priority_fee_per_gas",
    "transaction_type",
)

BLOCK_FIELDS = (
    "number", "hash", "parent_hash", "nonce", "sha3_uncles", "logs_bloom",
    "transactions_root", "state_root", "receipts_root", "miner",
    "difficulty", "total_difficulty", "size", "extra_data", "gas_limit",
    "gas_used", "timestamp", "transaction_count", "base_fee_per_gas",
)

CONTRACT_FIELDS = (
    "address", "bytecode", "function_sighashes", "is_erc20", "is_erc721",
    "block_number",
)

# The five fixed-width hex columns of a block whose text storage is measured.
HEX_BLOCK_FIELDS = (
    "sha3_uncles", "logs_bloom", "transactions_root", "state_root",
    "receipts_root",
)

# One hex digit stores four bits; "0x" prefix is two characters.
BITS_PER_HEX_DIGIT = 4
HEX_PREFIX_LENGTH = 2

# Bits to gigabytes, as in the published overhead figure (1 / 8e9).
GB_PER_BIT = 1.25e-10

# Month label format of every monthly series ("2015/08").
MONTH_FORMAT = "yyyy/MM"

# First and last second of the years 1 and 9999 (UTC).
MIN_EPOCH = -62_135_596_800
MAX_EPOCH = 253_402_300_799

# ---------------------------------------------------------------------------
# Spark types
# ---------------------------------------------------------------------------

# Exact wei amounts: 38 digits hold every sum of the export (about 6e27).
WEI = T.DecimalType(38, 0)
# Amounts that the lenient number rule accepts (e.g. "5.7", "1e18") keep six
# fraction digits, so sums stay exact and independent of summation order.
AMOUNT = T.DecimalType(38, 6)
# Gas of one transaction: 12 whole digits are plenty, and 18 digits fit one long.
GAS = T.DecimalType(18, 6)

FIELD_INDEX = {
    "transactions": {n: i for i, n in enumerate(TRANSACTION_FIELDS)},
    "blocks": {n: i for i, n in enumerate(BLOCK_FIELDS)},
    "contracts": {n: i for i, n in enumerate(CONTRACT_FIELDS)},
}
