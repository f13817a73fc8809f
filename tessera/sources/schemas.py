"""Typed tables of the capital and trade examples."""

from __future__ import annotations

# The columns of the two tables.
CAPITAL_POSITION = (
    "reporting_date date, entity string, cet1_capital_mm decimal(18,2), rwa_mm decimal(18,2), "
    "cet1_ratio_pct decimal(6,4), combined_buffer decimal(6,4)"
)
TRADE_EXPOSURE = (
    "trade_id string, counterparty string, instrument_type string, notional_usd_mm decimal(18,2), "
    "settlement_date date, credit_rating string, region string, status string"
)
