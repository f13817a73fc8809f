"""Measure formulas such as ``total:sum / *:count`` and ``cumsum(*:count)``.

A formula is arithmetic over ``column:aggregate`` terms. Every term becomes an aggregate with
the alias ``column_aggregate`` (``*:count`` becomes ``count``); the arithmetic is then applied to
the aggregated columns. Python's own expression reader takes the arithmetic apart, so that
nothing but numbers, names, ``+ - * /`` and the two window calls is accepted.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numbers import ratio

WINDOW_CALLS = ("cumsum", "change")

_TERM = re.compile(r"(\*|[A-Za-z_]\w*)\s*:\s*([A-Za-z_]\w*)")


@dataclass(frozen=True)
class Term:
    """One aggregate over one column; ``column`` is ``*`` for the row count."""

    column: str
    aggregate: str

    @property
    def alias(self) -> str:
        return self.aggregate if self.column == "*" else f"{self.column}_{self.aggregate}"


@dataclass(frozen=True)
class Formula:
    text: str
    name: str
    terms: tuple[Term, ...]
    tree: ast.expr


def parse(text: str, name: str | None = None) -> Formula:
    """Read a formula; plain names (of metrics, say) are allowed beside terms."""
    terms: list[Term] = []

    def alias(found: re.Match) -> str:
        term = Term(found.group(1), found.group(2).lower())
        if term not in terms:
            terms.append(term)
        return term.alias

    rewritten = _TERM.sub(alias, text).strip()
    try:
        tree = ast.parse(rewritten, mode="eval").body
    except SyntaxError as error:
        raise ValueError(f"cannot read the formula {text!r}") from error
    return Formula(text, name or _default_name(rewritten), tuple(terms), tree)


def _default_name(text: str) -> str:
    """The terms joined by the operators' names; a quotient is named by its terms alone."""
    for sign, word in (("+", " plus "), ("-", " minus "), ("*", " times ")):
        text = text.replace(sign, word)
    return re.sub(r"\W+", "_", text).strip("_")


def names(tree: ast.expr) -> list[str]:
    """Column names the arithmetic refers to, window calls excluded."""
    calls = {id(node.func) for node in ast.walk(tree) if isinstance(node, ast.Call)}
    found = [node.id for node in ast.walk(tree) if isinstance(node, ast.Name) and id(node) not in calls]
    return list(dict.fromkeys(found))


def has_window(tree: ast.expr) -> bool:
    return any(isinstance(node, ast.Call) for node in ast.walk(tree))


def odd_name(name: str) -> str:
    """The column beside an exact sum that holds what no decimal can: NaN, infinities, huge amounts."""
    return f"{name}__odd"


def settled(tree: ast.expr, exact: Collection[str], window: Callable[[str, Column], Column] | None = None) -> Column:
    """The arithmetic in decimals over exact sums, as a double; in doubles where a sum has an odd part."""
    column, used = to_column(tree, window), [n for n in names(tree) if n in exact]
    if not used:
        return column
    column = column.cast("double")
    if has_window(tree):
        return column
    odd = reduce(lambda a, b: a | b, (F.col(f"`{odd_name(n)}`").isNotNull() for n in used))

    def value(name: str) -> Column:
        plain = F.col(f"`{name}`").cast("double")
        extra = F.col(f"`{odd_name(name)}`")
        return F.when(extra.isNotNull(), F.coalesce(plain, F.lit(0.0)) + extra).otherwise(plain) if name in used else plain

    return F.when(odd, to_column(tree, value=value).cast("double")).otherwise(column)


def to_column(
    tree: ast.expr,
    window: Callable[[str, Column], Column] | None = None,
    value: Callable[[str], Column] = lambda name: F.col(f"`{name}`"),
) -> Column:
    """Arithmetic over already aggregated columns; division by zero gives null."""
    match tree:
        case ast.Name(id=name):
            return value(name)
        case ast.Constant(value=value) if isinstance(value, int | float) and not isinstance(value, bool):
            return F.lit(value)
        case ast.UnaryOp(op=ast.USub(), operand=operand):
            return -to_column(operand, window, value)
        case ast.BinOp(left=left, op=op, right=right):
            a, b = to_column(left, window, value), to_column(right, window, value)
            match op:
                case ast.Add():
                    return a + b
                case ast.Sub():
                    return a - b
                case ast.Mult():
                    return a * b
                case ast.Div():
                    return ratio(a, b)
        case ast.Call(func=ast.Name(id=call), args=[inner], keywords=[]) if call in WINDOW_CALLS and window:
            return window(call, to_column(inner, window, value))
    raise ValueError(f"unsupported in a formula: {ast.unparse(tree)}")
