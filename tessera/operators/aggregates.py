"""Aggregates that can be taken in two steps: before a join and again after it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numbers import exact_parts, exact_total, ratio


@dataclass(frozen=True)
class Aggregate:
    """``states`` maps a state name to (aggregate over rows, aggregate over states)."""

    states: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]]
    result: Callable[[dict[str, Column]], Column]
    #: Whether the result is a decimal, beside which the state ``odd`` holds what no decimal can.
    exact: bool = False

    def partial(self, value: Column, alias: str) -> list[Column]:
        return [first(value).alias(f"{alias}__{state}") for state, (first, _) in self.states.items()]

    def merge(self, alias: str) -> list[Column]:
        return [merge(F.col(f"{alias}__{s}")).alias(f"{alias}__{s}") for s, (_, merge) in self.states.items()]

    def finish(self, alias: str) -> Column:
        return self.result({s: F.col(f"{alias}__{s}") for s in self.states}).alias(alias)


def _average(states: dict[str, Column]) -> Column:
    return ratio(states["sum"], states["n"])


_SUM = (F.sum, F.sum)
_COUNT = (F.count, F.sum)

AGGREGATES: dict[str, Aggregate] = {
    "sum": Aggregate({"sum": _SUM}, lambda s: s["sum"]),
    "count": Aggregate({"n": _COUNT}, lambda s: F.coalesce(s["n"], F.lit(0).cast("bigint"))),
    "avg": Aggregate({"sum": _SUM, "n": _COUNT}, _average),
    "average": Aggregate({"sum": _SUM, "n": _COUNT}, _average),
    "min": Aggregate({"min": (F.min, F.min)}, lambda s: s["min"]),
    "max": Aggregate({"max": (F.max, F.max)}, lambda s: s["max"]),
}


def _exact(name: str, scale: int) -> Aggregate:
    """A sum or an average of doubles that hold amounts of ``scale`` decimals."""

    def part(which: str) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
        return (lambda value: F.sum(exact_parts(value, scale)[which])), F.sum

    def total(states: dict[str, Column]) -> Column:
        return exact_total(states["high"], states["low"], states["rest"], scale)

    def average(states: dict[str, Column]) -> Column:
        plain, odd = total(states).cast("double"), states["odd"]
        return ratio(F.when(odd.isNotNull(), F.coalesce(plain, F.lit(0.0)) + odd).otherwise(plain), states["n"])

    states = {which: part(which) for which in ("high", "low", "rest", "odd")}
    if name == "sum":
        return Aggregate(states, total, exact=True)
    return Aggregate(states | {"n": _COUNT}, average)


def aggregate(name: str, scale: int | None = None) -> Aggregate:
    """The aggregate of that name; with a ``scale``, sums of doubles that hold amounts lose nothing."""
    if name not in AGGREGATES:
        raise ValueError(f"unknown aggregate {name!r}, expected one of {', '.join(AGGREGATES)}")
    if scale is not None and name in ("sum", "avg", "average"):
        return _exact(name, scale)
    return AGGREGATES[name]
