"""Balance-sheet style positions: ratios, headroom, flags, latest value, growth and trend."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import as_date
from tessera.functions.numbers import percent, ratio
from tessera.operators import running


def headroom(value: str, requirement: str) -> Column:
    """How far a value lies above what is required."""
    return F.col(value) - F.col(requirement)


def compliance(value: Column, minimum: Column, margin: Column) -> Column:
    """``compliant`` or ``breach``; unknown inputs give null, not a pass."""
    return F.when((value >= minimum) & (margin >= 0), "compliant").when((value < minimum) | (margin < 0), "breach")


def ratio_of_sums(df: DataFrame, numerator: str, denominator: str, by: Sequence[str] = ()) -> DataFrame:
    """The sums, and their ratio in percent. Not the average of the row ratios."""
    sums = df.groupBy(*by).agg(F.sum(numerator).alias("numerator"), F.sum(denominator).alias("denominator"))
    return sums.withColumn("ratio_of_sums", percent("numerator", "denominator"))


def latest_row(df: DataFrame, time: str, tiebreak: Sequence[str]) -> DataFrame:
    """The newest row of the table."""
    return df.orderBy(F.col(time).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(1)


def latest_per(df: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row per key as one aggregate; no task sees a whole key.

    Rows of the same time are settled by the largest ``tiebreak`` columns, all others if none are
    named. Rows without a time come last: a key that has no other keeps one of them.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(time), *[F.col(c) for c in tiebreak or [c for c in rest if c != time]])
    row = F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, "__row.*")


def growth_since(df: DataFrame, keys: Sequence[str], time: str, value: str, base: dt.date | str) -> DataFrame:
    """First and last value on or after ``base``, with absolute and percent growth.

    Several rows of one key and time are summed first.
    """
    period = df.where(F.col(time) >= as_date(base))
    ends = period.groupBy(*keys, time).agg(F.sum(value).alias(value)).groupBy(*keys).agg(
        F.min_by(value, time).alias("first_value"),
        F.max_by(value, time).alias("last_value"),
    )
    grown = F.col("last_value") - F.col("first_value")
    return ends.withColumn("growth", grown).withColumn("growth_pct", percent(grown, F.col("first_value")))


def period_change(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str) -> DataFrame:
    """Change against the period before, per key; null for the first one."""
    return running.change(df, F.col(value), out, order=time, by=keys)


def trend(df: DataFrame, time: str, numerator: str, denominator: str, value: str) -> DataFrame:
    """Per period: the average of the stored ratios beside the ratio of the sums, in order."""
    totals = df.groupBy(time).agg(
        F.avg(value).alias("average_ratio"),
        ratio(F.sum(numerator), F.sum(denominator)).alias("__share"),
    )
    return totals.select(time, "average_ratio", (F.col("__share") * 100).alias("ratio_of_sums")).orderBy(time)
