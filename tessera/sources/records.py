"""Result rows as JSON records, in which dates and decimals travel as strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AS_TEXT = (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def as_records(df: DataFrame) -> DataFrame:
    """One JSON object per row in the column ``value``; null fields are kept."""
    fields = [
        F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, _AS_TEXT) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def write_records(df: DataFrame, path: str) -> None:
    as_records(df).write.mode("overwrite").text(path)
