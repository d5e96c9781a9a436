"""Structured Streaming form of the monthly questions."""

from chaintally.streaming.monthly import (
    monthly_totals_stream,
    run_monthly_value_stream,
    start_monthly_value_stream,
)

__all__ = ["monthly_totals_stream", "run_monthly_value_stream", "start_monthly_value_stream"]
