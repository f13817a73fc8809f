"""Text measures used by answer reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def size_label(chars: Column) -> Column:
    """Readable size: a dash for nothing, ``950ch`` below a thousand, ``1.2k`` from there."""
    thousands = F.regexp_replace(F.format_number(chars / F.lit(1000.0), 1), ",", "")
    return (
        F.when(chars == 0, F.lit("—"))
        .when(chars < 1000, F.concat(chars.cast("string"), F.lit("ch")))
        .otherwise(F.concat(thousands, F.lit("k")))
    )


def preview(col: Column, width: int = 400) -> Column:
    return F.substring(col, 1, width)

