"""Exposure to parties: open amounts, settlement horizon, rating scale and concentration."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import as_date
from tessera.functions.numbers import exact_sum, percent


def due_this_week(col: Column, as_of: dt.date | str) -> Column:
    """Settles from ``as_of`` to the Sunday of its week."""
    day = dt.date.fromisoformat(str(as_of))
    return due_within(col, day, 6 - day.weekday(), overdue=False)


def due_within(col: Column, as_of: dt.date | str, days: int, overdue: bool = True) -> Column:
    """Settles no later than ``days`` after ``as_of``; overdue items count unless ruled out.

    The date is compared as it is stored, so that the bound reaches the file scan.
    """
    last = dt.date.fromisoformat(str(as_of)) + dt.timedelta(days=days)
    before = col < as_date(last + dt.timedelta(days=1))
    return before if overdue else before & (col >= as_date(as_of))


def within_last(col: Column, as_of: dt.date | str, days: int) -> Column:
    """Falls in the ``days`` days up to and including ``as_of``."""
    end = dt.date.fromisoformat(str(as_of))
    return (col > as_date(end - dt.timedelta(days=days))) & (col < as_date(end + dt.timedelta(days=1)))


def rated_at_or_below(col: Column, floor: str, scale: Sequence[str]) -> Column:
    """Stands at ``floor`` or worse on a scale listed from best to worst.

    Values off the scale do not pass. A plain ``IN`` list, which scans can push down.
    """
    if floor not in scale:
        raise ValueError(f"{floor!r} is not on the scale {', '.join(scale)}")
    return col.isin(*scale[list(scale).index(floor) :])


def exposure_by(df: DataFrame, keys: Sequence[str], amount: str, out: str = "exposure", scale: int = 2) -> DataFrame:
    """Sum and number of trades per key; amounts are doubles of ``scale`` decimals."""
    return df.groupBy(*keys).agg(exact_sum(amount, scale).alias(out), F.count(F.lit(1)).alias("trades"))


def concentration(df: DataFrame, keys: Sequence[str], amount: Column, out: str = "exposure") -> DataFrame:
    """Exposure per key and its share of the total in percent; decimals are summed as they are.

    The total comes from the grouped rows as a scalar subquery: the groups are neither joined
    with it nor gathered under one window.
    """
    grouped = df.groupBy(*keys).agg(F.sum(amount).alias(out))
    total = grouped.agg(F.sum(out)).scalar()
    return grouped.withColumn("share_pct", percent(F.col(out), total))
