"""Ledger analytics on Spark: typed sources with a reject lane, monthly
series, top-k reports, storage overhead and scam income, as DataFrame
operators."""

__version__ = "0.1.0"
