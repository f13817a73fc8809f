"""Contract checks, service levels and conformance, evaluated over whole tables.

All rules of a table that need no grouping are taken in a single pass.
"""

from __future__ import annotations

import ast
import datetime as dt
import operator
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import Period, add_business_days, as_date, truncate
from tessera.functions.numbers import percent
from tessera.sources.contracts import ColumnSpec, Contract, type_matches

_COMPARE: dict[str, Callable] = {
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<=": operator.le,
    ">=": operator.ge,
    "<": operator.lt,
    ">": operator.gt,
}
_RULE = re.compile(r"^(\w+)(?:\(([^)]*)\))?\s*(==|!=|<>|<=|>=|=|<|>)\s*(-?\d+(?:\.\d+)?)$")
_MEMBER = re.compile(r"^(\w+)\s+in\s+(\[.*\])$", re.IGNORECASE)


@dataclass(frozen=True)
class Check:
    """``kind(columns) op bound``, or a count of values outside ``allowed``."""

    text: str
    kind: str
    columns: tuple[str, ...]
    op: str
    bound: float
    allowed: tuple = ()

    @classmethod
    def parse(cls, text: str) -> Check:
        text = text.strip()
        member = _MEMBER.match(text)
        if member:
            return cls(text, "invalid_count", (member.group(1),), "=", 0.0, tuple(ast.literal_eval(member.group(2))))
        rule = _RULE.match(text)
        if not rule:
            raise ValueError(f"cannot read the check {text!r}")
        kind, inside, op, bound = rule.groups()
        columns = tuple(c.strip() for c in (inside or "").split(",") if c.strip())
        if kind not in _OBSERVE and kind != "duplicate_count":
            raise ValueError(f"unknown check {kind!r} in {text!r}")
        if (kind == "row_count") != (not columns) or (kind in _OBSERVE and len(columns) > 1):
            raise ValueError(f"wrong columns in the check {text!r}")
        return cls(text, kind, columns, op, float(bound))

    def observed(self) -> Column:
        return _OBSERVE[self.kind](self).cast("double")

    def passed(self, observed: Column) -> Column:
        """A value that cannot be observed, such as the minimum of nothing, fails."""
        return F.coalesce(_COMPARE[self.op](observed, F.lit(self.bound)), F.lit(False))


_OBSERVE: dict[str, Callable[[Check], Column]] = {
    "row_count": lambda c: F.count(F.lit(1)),
    "missing_count": lambda c: F.count_if(F.col(c.columns[0]).isNull()),
    "invalid_count": lambda c: F.count_if(~F.col(c.columns[0]).isin(*c.allowed)),
    "min": lambda c: F.min(c.columns[0]),
    "max": lambda c: F.max(c.columns[0]),
}


def _verdicts(row: DataFrame, table: str, checks: Sequence[Check], values: Sequence[str]) -> DataFrame:
    structs = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check.text).alias("check_text"),
            F.col(value).alias("observed"),
            check.passed(F.col(value)).alias("passed"),
        )
        for check, value in zip(checks, values, strict=True)
    ]
    return row.select(F.inline(F.array(*structs)))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values carried by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_report(df: DataFrame, table: str, rules: Sequence[str | Check]) -> DataFrame:
    """One row per check: what was observed and whether it passed."""
    checks = [r if isinstance(r, Check) else Check.parse(r) for r in rules]
    single = [c for c in checks if c.kind != "duplicate_count"]
    parts = []
    if single:
        values = [f"v{i}" for i in range(len(single))]
        row = df.agg(*[c.observed().alias(v) for c, v in zip(single, values, strict=True)])
        parts.append(_verdicts(row, table, single, values))
    for check in checks:
        if check.kind == "duplicate_count":
            row = duplicate_groups(df, check.columns).agg(F.count(F.lit(1)).cast("double").alias("v"))
            parts.append(_verdicts(row, table, [check], ["v"]))
    return reduce(DataFrame.unionByName, parts)


def contract_report(df: DataFrame, contract: Contract, table: str) -> DataFrame:
    """Evaluate every check a contract declares for a table."""
    return check_report(df, table, contract.checks[table])


def completeness(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Filled rows and percent per column, all columns in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    structs = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(c).alias("filled_rows"),
            percent(F.col(c), F.col("__n")).alias("completeness_pct"),
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*structs)))


def schema_conformance(df: DataFrame, table: str, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Declared against actual columns: present, of a fitting type, and filled if required."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    present = [s for s in specs if s.name in actual]
    counts = [F.count_if(F.col(s.name).isNull()).alias(s.name) for s in present]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *counts)
    structs = []
    for spec in specs:
        here = spec.name in actual
        fits = here and type_matches(spec.type, actual[spec.name])
        nulls = F.col(spec.name) if here else F.lit(None).cast("bigint")
        filled = F.lit(True) if not spec.required else F.coalesce(nulls == 0, F.lit(False))
        structs.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(spec.name).alias("column_name"),
                F.lit(spec.type).alias("declared_type"),
                F.lit(actual[spec.name].simpleString() if here else None).cast("string").alias("actual_type"),
                F.lit(fits).alias("type_ok"),
                nulls.alias("null_rows"),
                (F.lit(fits) & filled).alias("conforms"),
            )
        )
    return row.select(F.inline(F.array(*structs)))


def required_date(as_of: dt.date | str, promise: str) -> Column:
    """The newest date that must be in a table on ``as_of``.

    ``T+n`` asks for data no older than ``n`` business days. ``PnD`` (``PnW``: five a week) asks for the last quarter
    end whose deadline of ``n`` business days has passed; months, as in ``P1M``, are added first.
    """
    today = as_date(as_of)
    rolling = re.match(r"^T\+(\d+)$", promise.strip())
    if rolling:
        return add_business_days(today, -int(rolling.group(1)))
    period = Period.parse(promise)
    ends = [F.date_sub(truncate(today, "quarter"), 1)]
    for _ in range(period.months // 3 + period.business_days // 60 + 1):
        ends.append(F.date_sub(truncate(ends[-1], "quarter"), 1))
    due = [F.when(add_business_days(F.add_months(end, period.months), period.business_days) <= today, end) for end in ends]
    return F.coalesce(*due)


def freshness(df: DataFrame, table: str, column: str, as_of: dt.date | str, promise: str) -> DataFrame:
    """Newest entry up to ``as_of`` against the newest one the promise requires."""
    known = df.where(F.col(column) < F.date_add(as_date(as_of), 1))
    newest = known.agg(F.max(column).cast("date").alias("newest"))
    needed = required_date(as_of, promise)
    return newest.select(
        F.lit(table).alias("table_name"),
        F.lit(promise).alias("promise"),
        "newest",
        needed.alias("required"),
        F.coalesce(F.col("newest") >= needed, F.lit(False)).alias("fresh"),
        F.greatest(F.datediff(needed, "newest"), F.lit(0)).alias("days_late"),
    )


def retention_cutoff(as_of: dt.date | str, period: str) -> Column:
    return Period.parse(period).before(as_date(as_of))


def retained(df: DataFrame, column: str, as_of: dt.date | str, period: str) -> DataFrame:
    return df.where(F.col(column) >= retention_cutoff(as_of, period))


def retention_split(df: DataFrame, table: str, column: str, as_of: dt.date | str, period: str) -> DataFrame:
    """Rows inside and outside the retention period, counted in one pass."""
    keep = F.col(column) >= retention_cutoff(as_of, period)
    return df.agg(
        F.count_if(keep).alias("retained_rows"),
        F.count_if(~keep).alias("expired_rows"),
        F.count_if(F.col(column).isNull()).alias("undated_rows"),
    ).select(F.lit(table).alias("table_name"), "*")


def formula_mismatches(
    df: DataFrame, stored: str, numerator: str, denominator: str, tolerance: float
) -> DataFrame:
    """Rows whose stored ratio is further than ``tolerance`` from the recomputed percent.

    A ratio stored where none can be computed, or missing where one can, is a mismatch too.
    """
    recomputed = percent(numerator, denominator)
    off = F.abs(F.col(stored).cast("double") - recomputed) > tolerance
    one_sided = F.col(stored).isNull() != recomputed.isNull()
    return df.withColumn("recomputed", recomputed).where(off | one_sided)


def governed(df: DataFrame, contract: Contract) -> DataFrame:
    """Result rows that carry the owner, status and freshness promise of their contract."""
    fresh = contract.promise("freshness")
    return df.select(
        "*",
        F.lit(contract.owner).alias("data_owner"),
        F.lit(contract.status).alias("data_status"),
        F.lit(fresh.description if fresh else None).cast("string").alias("freshness_promise"),
    )
