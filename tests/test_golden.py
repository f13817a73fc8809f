"""Known results over the capital and trade rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from rows import CAPITAL_DDL, RATING_SCALE, capital_rows
from pyspark.sql import functions as F

from tessera.functions.numbers import exact_sum, percent
from tessera.operators import position, quality
from tessera.operators.exposure import concentration, due_within, exposure_by, rated_at_or_below, within_last
from tessera.operators.metrics import Dimension, Measure, Metric, MetricLayer, MetricModel
from tessera.operators.semantic import SemanticModel, SemanticQuery, run
from tessera.sources.spine import time_spine


def as_dict(rows, key, value):
    return {r[key]: float(r[value]) for r in rows}


def layer(frame):
    model = MetricModel(
        "capital_position",
        frame,
        measures=(
            Measure("cet1_capital_total", "sum", "cet1_capital_mm"),
            Measure("rwa_total", "sum", "rwa_mm"),
            Measure("cet1_ratio_avg", "average", "cet1_ratio_pct"),
            Measure("combined_buffer_avg", "average", "combined_buffer"),
            Measure("capital_now", "latest", "cet1_capital_mm"),
        ),
        dimensions=(Dimension("reporting_date", "time", grain="month"), Dimension("entity")),
        entities={"bank_entity": "entity"},
    )
    metrics = (
        Metric("cet1_ratio", measure="cet1_ratio_avg"),
        Metric("combined_buffer_requirement", measure="combined_buffer_avg"),
        Metric("cet1_capital", measure="cet1_capital_total"),
        Metric("rwa", measure="rwa_total"),
        Metric("capital_latest", measure="capital_now"),
        Metric("buffer_headroom", expr="cet1_ratio - combined_buffer_requirement"),
    )
    return MetricLayer([model], metrics)


def test_latest_row(capital):
    row = position.latest_row(capital, "reporting_date", ["entity"]).first()
    assert row.reporting_date == dt.date(2026, 3, 31)
    assert float(row.cet1_ratio_pct) == 14.83 and float(row.combined_buffer) == 9.75
    margin = position.latest_row(capital, "reporting_date", ["entity"]).select(
        position.headroom("cet1_ratio_pct", "combined_buffer").alias("h")
    )
    assert float(margin.first().h) == 5.08


def test_metric_by_month(capital):
    out = layer(capital).query(["cet1_ratio", "buffer_headroom"], group_by=["metric_time__month"]).collect()
    got = sorted((str(r[0]), round(r[1], 2), round(r[2], 2)) for r in out)
    assert got == [("2025-09-01", 14.39, 4.64), ("2025-12-01", 14.66, 4.91), ("2026-03-01", 14.83, 5.08)]


def test_semantic_max(capital):
    model = SemanticModel.from_frame("capital_position", capital)
    query = SemanticQuery.of(
        ["cet1_ratio_pct:max", "combined_buffer:max", "cet1_ratio_pct:max - combined_buffer:max"],
        order=[{"column": "cet1_ratio_pct_max"}],
    )
    row = run(model, query).first()
    assert [str(row[0]), str(row[1])] == ["14.8300", "9.7500"]
    assert float(row[2]) == 5.08


def test_simple_metrics(capital):
    row = layer(capital).query(["cet1_ratio", "cet1_capital", "capital_latest"]).first()
    assert round(row.cet1_ratio, 6) == 14.626667
    assert float(row.cet1_capital) == 84833.00
    assert float(row.capital_latest) == 29273.00


def test_ratio_of_sums_is_not_the_average(capital):
    row = position.ratio_of_sums(capital, "cet1_capital_mm", "rwa_mm").first()
    assert round(row.ratio_of_sums, 6) == 14.628902


def test_ratio_pct(capital):
    rows = capital.select(percent("cet1_capital_mm", "rwa_mm").alias("r")).collect()
    assert sorted(round(r.r, 4) for r in rows) == [14.3885, 14.6615, 14.8293]


def test_growth(capital):
    row = position.growth_since(capital, ["entity"], "reporting_date", "cet1_capital_mm", "2025-09-30").first()
    assert float(row.growth) == 1863.00


def test_quarter_over_quarter(capital):
    rows = position.period_change(capital, ["entity"], "reporting_date", "rwa_mm", "d").orderBy("reporting_date")
    assert [None if r.d is None else float(r.d) for r in rows.collect()] == [None, 1500.00, 5400.00]


def test_trend(capital):
    rows = position.trend(capital, "reporting_date", "cet1_capital_mm", "rwa_mm", "cet1_ratio_pct").collect()
    assert [float(r.average_ratio) for r in rows] == [14.39, 14.66, 14.83]


# The checks declared for the two tables.
CAPITAL_CHECKS = [
    "row_count > 0",
    "duplicate_count(reporting_date, entity) = 0",
    "missing_count(cet1_ratio_pct) = 0",
    "missing_count(combined_buffer) = 0",
    "min(cet1_ratio_pct) > 0",
    "max(combined_buffer) < 25",
    "min(rwa_mm) > 0",
    "min(cet1_capital_mm) > 0",
]
TRADE_CHECKS = [
    "missing_count(counterparty) = 0",
    "missing_count(notional_usd_mm) = 0",
    "missing_count(settlement_date) = 0",
    "missing_count(credit_rating) = 0",
    "min(notional_usd_mm) > 0",
    "status in ['OPEN', 'SETTLED', 'DEFAULTED']",
    "credit_rating in ['AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC']",
    "row_count > 0",
]


def test_checks_pass(capital, trades):
    assert quality.check_report(capital, "capital_position", CAPITAL_CHECKS).where("passed").count() == 8
    assert quality.check_report(trades, "trade_exposure", TRADE_CHECKS).where("passed").count() == 8


def test_checks_fail_on_bad_rows(spark):
    bad = spark.createDataFrame(
        capital_rows(
            [
                ("2025-09-30", "A", "10", "0", None, "30"),
                ("2025-09-30", "A", "-1", "100", "1", "9.75"),
            ]
        ),
        CAPITAL_DDL,
    )
    rows = quality.check_report(bad, "capital_position", CAPITAL_CHECKS).collect()
    assert {r.check_text for r in rows if r.passed} == {
        "row_count > 0",
        "missing_count(combined_buffer) = 0",
        "min(cet1_ratio_pct) > 0",
    }


def test_stored_ratio_within_tolerance(capital):
    assert quality.formula_mismatches(capital, "cet1_ratio_pct", "cet1_capital_mm", "rwa_mm", 0.005).count() == 0
    assert quality.formula_mismatches(capital, "cet1_ratio_pct", "cet1_capital_mm", "rwa_mm", 0.001).count() == 2


def test_open_exposure(trades):
    open_trades = trades.where("status = 'OPEN'")
    by_party = exposure_by(open_trades, ["counterparty"], F.col("notional_usd_mm")).collect()
    assert as_dict(by_party, "counterparty", "exposure") == {
        "JPMORGAN": 890,
        "GOLDMAN_SACHS": 790,
        "CITIBANK": 560,
        "BARCLAYS": 460,
        "HSBC": 410,
        "DEUTSCHE_BANK": 320,
        "CREDIT_SUISSE": 220,
    }
    by_region = exposure_by(open_trades, ["region"], F.col("notional_usd_mm")).collect()
    assert as_dict(by_region, "region", "exposure") == {"NORTH_AMERICA": 2240, "EUROPE": 1410}
    by_kind = exposure_by(open_trades, ["instrument_type"], F.col("notional_usd_mm")).collect()
    assert as_dict(by_kind, "instrument_type", "exposure") == {"FX_FORWARD": 2030, "BOND": 880, "DERIVATIVE": 740}


def test_concentration(trades):
    rows = concentration(trades.where("status = 'OPEN'"), ["credit_rating"], F.col("notional_usd_mm")).collect()
    assert as_dict(rows, "credit_rating", "exposure") == {"AA": 1660, "AAA": 890, "A": 880, "BB": 220}
    assert sum(r.share_pct for r in rows) == pytest.approx(100)


def test_settlement_horizon(trades):
    due = trades.where("status = 'OPEN'").where(due_within(F.col("settlement_date"), "2026-05-24", 30))
    assert sorted(r.trade_id for r in due.collect()) == ["T001", "T002", "T003", "T004", "T005", "T006", "T008"]
    assert float(due.agg(F.sum("notional_usd_mm")).first()[0]) == 3030
    later = trades.where(due_within(F.col("settlement_date"), "2026-06-02", 30, overdue=False))
    assert sorted(r.trade_id for r in later.collect()) == ["T002", "T006", "T007", "T009"]


def test_within_last_days(trades):
    rows = trades.where(within_last(F.col("settlement_date"), "2026-05-30", 3)).collect()
    assert sorted(r.trade_id for r in rows) == ["T001", "T003", "T008"]


def test_rating_scale(trades):
    rows = trades.where("status = 'OPEN'").where(rated_at_or_below(F.col("credit_rating"), "BB", RATING_SCALE))
    assert [(r.trade_id, float(r.notional_usd_mm)) for r in rows.collect()] == [("T005", 220)]
    with pytest.raises(ValueError, match="scale"):
        rated_at_or_below(F.col("credit_rating"), "D", RATING_SCALE)


def test_time_spine(spark):
    days = time_spine(spark, "2025-01-01", "2027-01-01")
    assert days.count() == 730
    assert str(days.agg(F.max("date_day")).first()[0]) == "2026-12-31"
    assert time_spine(spark, "2025-01-01", "2025-01-01").count() == 0


def test_compliance(spark):
    df = spark.createDataFrame([(14.8, 5.1), (4.0, 5.0), (14.8, -0.1), (None, None)], "r double, h double")
    flag = position.compliance(F.col("r"), F.lit(4.5), F.col("h"))
    assert [r.f for r in df.select(flag.alias("f")).collect()] == ["compliant", "breach", "breach", None]


def test_maximum_is_not_latest(spark):
    falling = spark.createDataFrame(
        capital_rows(
            [
                ("2025-09-30", "A", "10", "100", "15", "9"),
                ("2025-12-31", "A", "9", "100", "12", "9"),
                ("2025-12-31", "B", "5", "100", "8", "9"),
            ]
        ),
        CAPITAL_DDL,
    )
    rows = position.latest_per(falling, ["entity"], "reporting_date").collect()
    assert as_dict(rows, "entity", "cet1_ratio_pct") == {"A": 12, "B": 8}
    total = layer(falling).query(["capital_latest", "cet1_capital"]).first()
    assert (float(total.capital_latest), float(total.cet1_capital)) == (14, 24)


def _sum(spark, values, scale=2):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    return df.agg(exact_sum("v", scale).alias("x")).first().x


def test_sums_of_amounts_lose_nothing(spark):
    values = [0.1, 0.2, 0.29, -1.15, 1234567890.07, 99999999999.99, -0.01, None]
    total = sum(Decimal(str(v)) for v in values if v is not None)
    assert _sum(spark, values * 30) == float(30 * total)
    assert _sum(spark, [0.004] * 1000) == 4.0 and _sum(spark, [0.004] * 1000, 0) == 4.0
    assert _sum(spark, [1e17, 1e17, 0.01, -1e17]) == 1e17
    assert _sum(spark, [190000000000000.11]) == 190000000000000.11
    assert _sum(spark, [9e15, 0.25] * 100) == 9e17 + 25
    assert _sum(spark, [2.0**70, 1.0, -(2.0**70)]) in (0.0, 1.0)
    assert _sum(spark, []) is None and _sum(spark, [None]) is None


def test_numbers_that_no_amount_can_be_pass_through(spark):
    import math

    assert math.isnan(_sum(spark, [1.0, float("nan")])) and _sum(spark, [1.0, float("inf")]) == float("inf")
    rows = [("a", 1.5), ("a", float("nan")), ("b", 2.25), ("b", 0.004), ("c", None)]
    model = SemanticModel.from_frame("t", spark.createDataFrame(rows, "k string, v double"), exact={"v": 2})
    measures = ["v:sum", "v:avg", "v:sum + v:sum", "v:sum / *:count"]
    got = {r.k: r for r in run(model, SemanticQuery.of(measures=measures, dimensions=["k"])).collect()}
    assert all(math.isnan(got["a"][c]) for c in ("v_sum", "v_avg", "v_sum_plus_v_sum", "v_sum_count"))
    assert got["b"]["v_sum"] == 2.254 and got["b"]["v_sum_plus_v_sum"] == 4.508 and got["c"]["v_sum"] is None
    kept = {r.k: r.v_sum for r in run(model, SemanticQuery.of(measures=["v:sum"], dimensions=["k"]), decimals=True).collect()}
    assert kept["b"] == Decimal("2.254") and kept["a"] == Decimal("1.5") or kept["a"] is None


def test_formulas_need_different_names(spark):
    model = SemanticModel.from_frame("t", spark.createDataFrame([(1.0, 2.0)], "a double, b double"))
    out = run(model, SemanticQuery.of(measures=["a:sum + b:sum", "a:sum - b:sum", "a:sum * b:sum"]))
    assert out.columns == ["a_sum_plus_b_sum", "a_sum_minus_b_sum", "a_sum_times_b_sum"]
    with pytest.raises(ValueError, match="several columns"):
        run(model, SemanticQuery.of(measures=["(a:sum + b:sum) * 2", "a:sum + b:sum * 2"]))


def test_limits_without_an_order_are_repeatable(spark):
    frame = spark.range(1000).selectExpr("id % 50 AS k", "id AS v").repartition(9)
    model = SemanticModel.from_frame("t", frame)
    rows = run(model, SemanticQuery.of(measures=["*:count"], dimensions=["k"], limit=3)).collect()
    assert [r.k for r in rows] == [0, 1, 2]


def test_undated_keys_and_ties(spark):
    rows = [("a", None, 1.0), ("b", "2024-01-01", 2.0), ("b", None, 9.0), ("c", "2024-01-01", 3.0), ("c", "2024-01-01", 4.0)]
    rows += [("c", "2024-06-30", 7.0), ("c", "2024-06-30", 1.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.col("d").cast("date")).repartition(5)
    latest = {r.k: (r.d and str(r.d), r.v) for r in position.latest_per(df, ["k"], "d").collect()}
    assert latest == {"a": (None, 1.0), "b": ("2024-01-01", 2.0), "c": ("2024-06-30", 7.0)}
    grown = {r.k: (r.first_value, r.last_value) for r in position.growth_since(df, ["k"], "d", "v", "2024-01-01").collect()}
    assert grown == {"b": (2.0, 2.0), "c": (7.0, 8.0)}
