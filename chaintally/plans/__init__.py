"""Composite questions (``ledger``), the test-table binding and the query catalog."""
