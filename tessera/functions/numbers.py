"""Ratios and percentages that return null, not an error, on a zero divisor; lossless sums of amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` as a double; null where the divisor is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


#: Whole amounts are counted in blocks of this many, so that sums of either part stay 64-bit.
_BLOCK = 1 << 16


def exact_parts(value: Column | str, scale: int = 2) -> dict[str, Column]:
    """A double amount in parts whose sums lose nothing and do not depend on the order of adding.

    ``high`` and ``low`` count units of ``10^-scale``, in blocks and within a block. ``rest`` is what
    the units leave over: nothing for an amount of ``scale`` decimals. ``odd`` holds NaN, infinities
    and amounts of 1e20 and more, which no unit count can hold; for them the other parts are null.
    """
    unit = 10.0**scale
    given = _col(value).cast("double")
    usable = F.when(F.abs(given) < 1e20, given)
    blocks = F.floor(usable / _BLOCK)
    inner = usable - blocks.cast("double") * _BLOCK
    low = F.rint(inner * unit).cast("bigint")
    counted = (blocks.cast("double") * _BLOCK * unit + low.cast("double")) / unit
    # Up to here a double tells the units of an amount apart, and the nearest amount leaves no rest.
    rest = F.when(F.abs(usable) * unit < 9e15, usable - counted).otherwise(inner - low.cast("double") / unit)
    return {
        "high": blocks * F.lit(10**scale),
        "low": low,
        "rest": rest,
        "odd": F.when(~(F.abs(given) < 1e20), given),
    }


def exact_total(high: Column, low: Column, rest: Column, scale: int = 2) -> Column:
    """Summed parts as a decimal of at least six decimals. Only the rest, which amounts of ``scale`` decimals do
    not have, is rounded: to six decimals, once, after summing."""
    units = high.cast("decimal(19,0)") * F.lit(Decimal(_BLOCK)) + low.cast("decimal(19,0)")
    return units * F.lit(Decimal(1).scaleb(-scale)) + rest.cast(f"decimal(22,{max(scale, 6)})")


def exact_sum(value: Column | str, scale: int = 2) -> Column:
    """Sum of amounts held as doubles, without loss up to the double it returns."""
    return exact_sum_of(exact_parts(value, scale), scale)


def exact_sum_of(parts: dict[str, Column], scale: int = 2, when: Column | None = None) -> Column:
    """The sum from parts worked out before, such as columns of a projection, over the rows that ``when`` chooses."""
    summed = {name: F.sum(part if when is None else F.when(when, part)) for name, part in parts.items()}
    odd = summed.pop("odd")
    total = exact_total(**summed, scale=scale).cast("double")
    return F.when(odd.isNotNull(), F.coalesce(total, F.lit(0.0)) + odd).otherwise(total)


def percent_text(value: Column | str) -> Column:
    """``"4.5%"`` as 4.5."""
    return F.regexp_extract(_col(value), r"([0-9]+(?:\.[0-9]+)?)\s*%", 1).try_cast("double")


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double, leaving the others alone."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
