"""Running totals, changes and look-backs that do not gather a whole series in one task.

A plain window sorts each group in a single task. That is fine for aggregated periods, whose
number the calendar bounds. For anything longer, pass ``block``: a column that grows with the
order column and cuts the series into pieces of bounded length. Pieces are worked on in
parallel; one small row per piece carries the state from piece to piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_VALUE, _BLOCK, _INSIDE, _STATE, _CARRY = "__value", "__block", "__inside", "__state", "__carry"


def _earlier(by: Sequence[str], order: str, upto: int):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, upto)


def _with_carry(within: DataFrame, carries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring each piece's carried state to its rows; group keys may be null."""
    a, b = within.alias("a"), carries.alias("b")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    return a.join(b, same, "left").select("a.*", F.col(f"b.{_CARRY}"))


def cumulative(
    df: DataFrame, value: Column, out: str, order: str, by: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """Running total of ``value`` up to and including each row."""
    if block is None:
        return df.withColumn(out, F.sum(value).over(_earlier(by, order, 0)))
    keys = [*by, _BLOCK]
    cut = df.withColumn(_VALUE, value).withColumn(_BLOCK, block)
    within = cut.withColumn(_INSIDE, F.sum(_VALUE).over(_earlier(keys, order, 0)))
    carries = (
        cut.groupBy(*keys)
        .agg(F.sum(_VALUE).alias(_STATE))
        .withColumn(_CARRY, F.sum(_STATE).over(_earlier(by, _BLOCK, -1)))
    )
    inside, carry = F.col(_INSIDE), F.col(_CARRY)
    total = F.when(inside.isNull(), carry).when(carry.isNull(), inside).otherwise(inside + carry)
    return _with_carry(within, carries, keys).withColumn(out, total).drop(_VALUE, _INSIDE, _CARRY, _BLOCK)


def previous(
    df: DataFrame, value: Column, out: str, order: str, by: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """Latest non-null ``value`` among the rows before each row."""
    if block is None:
        return df.withColumn(out, F.last(value, ignorenulls=True).over(_earlier(by, order, -1)))
    keys = [*by, _BLOCK]
    cut = df.withColumn(_VALUE, value).withColumn(_BLOCK, block)
    within = cut.withColumn(_INSIDE, F.last(_VALUE, ignorenulls=True).over(_earlier(keys, order, -1)))
    carries = (
        cut.groupBy(*keys)
        .agg(F.max_by(F.col(_VALUE), F.when(F.col(_VALUE).isNotNull(), F.col(order))).alias(_STATE))
        .withColumn(_CARRY, F.last(_STATE, ignorenulls=True).over(_earlier(by, _BLOCK, -1)))
    )
    joined = _with_carry(within, carries, keys)
    return joined.withColumn(out, F.coalesce(_INSIDE, _CARRY)).drop(_VALUE, _INSIDE, _CARRY, _BLOCK)


def change(
    df: DataFrame, value: Column, out: str, order: str, by: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """``value`` minus the one of the row before; null for the first row."""
    boxed = df.withColumn("__box", F.struct(value.alias("v")))
    before = previous(boxed, F.col("__box"), "__before", order, by, block)
    return before.withColumn(out, F.col("__box.v") - F.col("__before.v")).drop("__box", "__before")
