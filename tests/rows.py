"""The rows that golden tests use."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tessera.sources.schemas import CAPITAL_POSITION as CAPITAL_DDL
from tessera.sources.schemas import TRADE_EXPOSURE as TRADE_DDL

__all__ = ["CAPITAL_DDL", "CAPITAL_ROWS", "RATING_SCALE", "TRADE_DDL", "TRADE_ROWS", "capital_rows", "trade_rows"]

# Capital positions of one entity over three quarters.
CAPITAL_ROWS = [
    ("2025-09-30", "BANK_HOLDCO", "27410.00", "190500.00", "14.39", "9.75"),
    ("2025-12-31", "BANK_HOLDCO", "28150.00", "192000.00", "14.66", "9.75"),
    ("2026-03-31", "BANK_HOLDCO", "29273.00", "197400.00", "14.83", "9.75"),
]

# Ten trades.
TRADE_ROWS = [
    ("T001", "GOLDMAN_SACHS", "FX_FORWARD", "450.00", "2026-05-30", "AA", "NORTH_AMERICA", "OPEN"),
    ("T002", "DEUTSCHE_BANK", "BOND", "320.00", "2026-06-15", "A", "EUROPE", "OPEN"),
    ("T003", "BARCLAYS", "DERIVATIVE", "180.00", "2026-05-28", "AA", "EUROPE", "OPEN"),
    ("T004", "JPMORGAN", "FX_FORWARD", "890.00", "2026-06-01", "AAA", "NORTH_AMERICA", "OPEN"),
    ("T005", "CREDIT_SUISSE", "BOND", "220.00", "2026-05-25", "BB", "EUROPE", "OPEN"),
    ("T006", "CITIBANK", "DERIVATIVE", "560.00", "2026-06-20", "A", "NORTH_AMERICA", "OPEN"),
    ("T007", "GOLDMAN_SACHS", "BOND", "340.00", "2026-07-01", "AA", "NORTH_AMERICA", "OPEN"),
    ("T008", "HSBC", "FX_FORWARD", "410.00", "2026-05-29", "AA", "EUROPE", "OPEN"),
    ("T009", "DEUTSCHE_BANK", "DERIVATIVE", "150.00", "2026-06-10", "A", "EUROPE", "SETTLED"),
    ("T010", "BARCLAYS", "FX_FORWARD", "280.00", "2026-07-15", "AA", "EUROPE", "OPEN"),
]
RATING_SCALE = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC")


def capital_rows(rows):
    return [(dt.date.fromisoformat(d), e, *(None if v is None else Decimal(v) for v in vs)) for d, e, *vs in rows]


def trade_rows(rows):
    return [(i, c, k, Decimal(n), dt.date.fromisoformat(s), *rest) for i, c, k, n, s, *rest in rows]
