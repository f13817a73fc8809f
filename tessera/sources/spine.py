"""Date series for period fill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import as_date, truncate


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, F.date_sub(end, 1), F.expr("interval 1 day")))


def time_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end``."""
    if str(end) <= str(start):
        return spark.range(0).select(F.lit(None).cast("date").alias("date_day"))
    return spark.range(1).select(_days(as_date(start), as_date(end)).alias("date_day"))


def spine_over(df: DataFrame, column: str) -> DataFrame:
    """Days from the first to the last date found in ``column``, both included."""
    day = F.col(column).cast("date")
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).where(F.col("first").isNotNull())
    return bounds.select(_days(F.col("first"), F.date_add("last", 1)).alias("date_day"))


def periods(spine: DataFrame, grain: str) -> DataFrame:
    """The spine's distinct periods at a coarser grain."""
    return spine.select(truncate(F.col("date_day"), grain).alias("period")).distinct()
