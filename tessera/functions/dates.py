"""Time grains, ISO-8601 periods and business-day arithmetic."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")

_PERIOD = re.compile(r"^P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?$")


def as_date(value: dt.date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def truncate(col: Column, grain: str) -> Column:
    """First day of the period that holds ``col``, as a date."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}, expected one of {', '.join(GRAINS)}")
    day = col.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def quarter_end(col: Column) -> Column:
    return F.last_day(F.add_months(truncate(col, "quarter"), 2))


@dataclass(frozen=True)
class Period:
    """A calendar length: whole months, weeks and days. A week is seven days, or five business days."""

    months: int
    days: int
    weeks: int = 0

    @property
    def business_days(self) -> int:
        return 5 * self.weeks + self.days

    @classmethod
    def parse(cls, text: str) -> Period:
        found = _PERIOD.match(text.strip())
        if not found or not any(found.groups()):
            raise ValueError(f"not an ISO-8601 date period: {text!r}")
        years, months, weeks, days = (int(g or 0) for g in found.groups())
        return cls(years * 12 + months, days, weeks)

    def before(self, col: Column) -> Column:
        return F.date_sub(F.add_months(col, -self.months), 7 * self.weeks + self.days)


def add_business_days(col: Column, days: int) -> Column:
    """``days`` working days (Monday to Friday) after, or before when negative, a date.

    A weekend start counts from its Friday when going forward and from its Monday when
    going back. No holiday calendar is applied.
    """
    weekday = F.weekday(col)
    if days >= 0:
        start = F.least(weekday, F.lit(4))
        rolled = F.date_sub(col, (weekday - start).cast("int"))
        weekends = F.floor((start + F.lit(days)) / 5).cast("int")
        return F.date_add(rolled, F.lit(days) + 2 * weekends)
    back = -days
    start = F.when(weekday >= 5, F.lit(0)).otherwise(weekday)
    rolled = F.date_add(col, F.when(weekday >= 5, 7 - weekday).otherwise(F.lit(0)).cast("int"))
    weekends = F.floor((F.lit(4 + back) - start) / 5).cast("int")
    return F.date_sub(rolled, F.lit(back) + 2 * weekends)
