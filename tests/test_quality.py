"""Checks, dates and service levels."""

from __future__ import annotations

import datetime as dt

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from tessera.functions.dates import Period, add_business_days, as_date, quarter_end, truncate
from tessera.operators import quality
from tessera.operators.quality import Check
from tessera.sources.contracts import ColumnSpec


def test_check_texts():
    check = Check.parse("duplicate_count(a, b) = 0")
    assert (check.kind, check.columns, check.op, check.bound) == ("duplicate_count", ("a", "b"), "=", 0.0)
    assert Check.parse("status in ['A', 'B']").allowed == ("A", "B")
    assert Check.parse("min(x) >= -1.5").bound == -1.5
    for text in ("nonsense", "median(x) > 1", "min(a, b) > 1", "row_count(a) > 1", "max() < 2"):
        with pytest.raises(ValueError):
            Check.parse(text)


def test_checks_of_a_table_take_one_pass(capital):
    rules = ["row_count > 0", "missing_count(entity) = 0", "min(rwa_mm) > 0", "entity in ['BANK_HOLDCO']"]
    plan = plan_of(quality.check_report(capital, "t", rules))
    assert plan.count("Scan ") == 1 and plan.count("Exchange") == 1


def test_nothing_to_observe_fails(spark):
    empty = spark.createDataFrame([], "a int")
    report = {r.check_text: r.passed for r in quality.check_report(empty, "t", ["min(a) > 0", "row_count = 0"]).collect()}
    assert report == {"min(a) > 0": False, "row_count = 0": True}


def test_nulls_are_missing_but_not_invalid(spark):
    df = spark.createDataFrame([("A",), (None,), ("Z",)], "s string")
    report = {r.check_text: r.observed for r in quality.check_report(df, "t", ["s in ['A']", "missing_count(s) = 0"]).collect()}
    assert report == {"s in ['A']": 1.0, "missing_count(s) = 0": 1.0}


def _step(day: dt.date, days: int) -> dt.date:
    while days:
        day += dt.timedelta(days=1 if days > 0 else -1)
        if day.weekday() < 5:
            days -= 1 if days > 0 else -1
    return day


@pytest.mark.parametrize("days", [1, 2, 5, 6, 13, -1, -3, -5, -11])
def test_business_days(spark, days):
    start = dt.date(2024, 1, 1)
    df = spark.range(30).select(F.date_add(as_date(start), F.col("id").cast("int")).alias("d"))
    for row in df.select("d", add_business_days(F.col("d"), days).alias("e")).collect():
        assert row.e == _step(row.d, days)


def test_periods():
    assert Period.parse("P3Y") == Period(36, 0)
    assert Period.parse("P1Y2M1W3D") == Period(14, 3, 1)
    for text in ("P", "3Y", "PT5H", "P-1D"):
        with pytest.raises(ValueError):
            Period.parse(text)


def test_grains(spark):
    row = spark.range(1).select(
        *[truncate(as_date("2024-05-16"), g).alias(g) for g in ("day", "week", "month", "quarter", "year")],
        quarter_end(as_date("2024-05-16")).alias("end"),
    ).first()
    assert [str(v) for v in row] == ["2024-05-16", "2024-05-13", "2024-05-01", "2024-04-01", "2024-01-01", "2024-06-30"]
    with pytest.raises(ValueError, match="grain"):
        truncate(F.col("x"), "hour")


@pytest.mark.parametrize(
    ("as_of", "promise", "required"),
    [
        ("2026-04-07", "P5D", "2026-03-31"),
        ("2026-04-06", "P5D", "2025-12-31"),
        ("2026-03-31", "P5D", "2025-12-31"),
        ("2026-04-29", "P1M", "2025-12-31"),
        ("2026-04-30", "P1M", "2026-03-31"),
        ("2026-06-30", "P6M", "2025-12-31"),
        ("2026-06-29", "P6M", "2025-09-30"),
        ("2026-06-20", "P90D", "2025-12-31"),
        ("2026-06-01", "T+1", "2026-05-29"),
        ("2026-06-03", "T+1", "2026-06-02"),
    ],
)
def test_required_date(spark, as_of, promise, required):
    assert str(spark.range(1).select(quality.required_date(as_of, promise)).first()[0]) == required


def test_freshness(capital):
    late = quality.freshness(capital.where("reporting_date < '2026-01-01'"), "t", "reporting_date", "2026-05-01", "P5D")
    row = late.first()
    assert (str(row.newest), str(row.required), row.fresh, row.days_late) == ("2025-12-31", "2026-03-31", False, 90)
    none = quality.freshness(capital.limit(0), "t", "reporting_date", "2026-05-01", "P5D").first()
    assert none.fresh is False


def test_retention(capital):
    row = quality.retention_split(capital, "t", "reporting_date", "2026-12-31", "P1Y").first()
    assert (row.retained_rows, row.expired_rows, row.undated_rows) == (2, 1, 0)
    assert quality.retained(capital, "reporting_date", "2026-12-31", "P1Y").count() == 2


def test_schema_conformance(capital):
    specs = [
        ColumnSpec("reporting_date", "date", required=True),
        ColumnSpec("cet1_ratio_pct", "string"),
        ColumnSpec("rwa_mm", "DECIMAL(18,2)", required=True),
        ColumnSpec("absent", "string", required=True),
    ]
    rows = {r.column_name: (r.type_ok, r.conforms) for r in quality.schema_conformance(capital, "t", specs).collect()}
    assert rows == {
        "reporting_date": (True, True),
        "cet1_ratio_pct": (False, False),
        "rwa_mm": (True, True),
        "absent": (False, False),
    }


def test_one_sided_ratio_is_a_mismatch(spark):
    df = spark.createDataFrame([(1, 50.0, 1.0, 2.0), (2, 50.0, 1.0, 0.0), (3, None, 1.0, 2.0)], "i int, s double, a double, b double")
    assert sorted(r.i for r in quality.formula_mismatches(df, "s", "a", "b", 0.005).collect()) == [2, 3]
