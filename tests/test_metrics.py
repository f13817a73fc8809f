"""Named metrics: grouping names, combination of models, period fill, validation."""

from __future__ import annotations

import datetime as dt

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from tessera.operators.metrics import Dimension, Measure, Metric, MetricLayer, MetricModel, entity_duplicates
from tessera.sources.spine import time_spine


@pytest.fixture(scope="module")
def layer(spark):
    day = dt.date
    sales = spark.createDataFrame(
        [(day(2024, 1, 5), "x", 10.0), (day(2024, 1, 9), None, 5.0), (day(2024, 3, 1), "x", 7.0)],
        "sold date, shop string, amount double",
    )
    visits = spark.createDataFrame([(day(2024, 2, 1), "x"), (day(2024, 3, 3), None)], "seen date, shop string")
    return MetricLayer(
        [
            MetricModel(
                "sales",
                sales,
                (Measure("amount", "sum", "amount"), Measure("newest", "latest", "amount")),
                (Dimension("sold", "time"), Dimension("shop")),
                entities={"store": "shop"},
            ),
            MetricModel(
                "visits", visits, (Measure("visits", "count", "seen"),), (Dimension("seen", "time"), Dimension("shop"))
            ),
        ],
        [
            Metric("revenue", measure="amount"),
            Metric("visitors", measure="visits"),
            Metric("per_visit", expr="revenue / visitors"),
            Metric("doubled", expr="per_visit * 2"),
            Metric("last_amount", measure="newest"),
        ],
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_models_meet_on_null_keys(layer):
    out = layer.query(["revenue", "visitors", "doubled"], group_by=["shop"])
    assert rows(out) == [("x", 17.0, 1, 34.0), (None, 5.0, 1, 10.0)]


def test_models_without_groups_give_one_row(layer):
    assert rows(layer.query(["revenue", "visitors", "per_visit"])) == [(22.0, 2, 11.0)]


def test_one_model_needs_no_join(layer):
    plan = plan_of(layer.query(["revenue"], group_by=["metric_time__month"]))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_period_fill(spark, layer):
    spine = time_spine(spark, "2024-01-01", "2024-04-01")
    out = layer.query(["revenue"], group_by=["metric_time__month"], spine=spine, order_by=["metric_time__month"])
    assert [tuple(r) for r in out.collect()] == [
        (dt.date(2024, 1, 1), 15.0),
        (dt.date(2024, 2, 1), None),
        (dt.date(2024, 3, 1), 7.0),
    ]


def test_latest_takes_the_newest_date_of_each_group(layer):
    assert rows(layer.query(["last_amount"], group_by=["shop"])) == [("x", 7.0), (None, 5.0)]
    assert rows(layer.query(["last_amount"])) == [(7.0,)]


def test_group_names(layer):
    wanted = layer.query(["revenue"], group_by=["store__shop", "store", "metric_time__year"])
    assert wanted.columns == ["store__shop", "store", "metric_time__year", "revenue"]
    with pytest.raises(ValueError, match="metric_time__day.*shop.*store"):
        layer.query(["revenue"], group_by=["colour"])
    with pytest.raises(ValueError, match="revenue, visitors"):
        layer.query(["profit"])
    with pytest.raises(ValueError, match="cannot be grouped"):
        layer.query(["visitors"], group_by=["store"])


def test_order_and_limit(layer):
    out = layer.query(["revenue"], group_by=["metric_time__day"], order_by=["-revenue"], limit=2)
    assert [r.revenue for r in out.collect()] == [10.0, 7.0]


def test_finer_grain_than_declared_is_refused(spark):
    model = MetricModel(
        "m",
        spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, v int"),
        (Measure("v", "sum", "v"),),
        (Dimension("d", "time", grain="month"),),
    )
    layer = MetricLayer([model], [Metric("v", measure="v")])
    assert layer.dimension_names() == ["metric_time__month", "metric_time__quarter", "metric_time__year", "d"]
    with pytest.raises(ValueError, match="finer"):
        layer.query(["v"], group_by=["d__day"])


def test_cycle_is_named(spark, layer):
    broken = MetricLayer([], [Metric("a", expr="b + 1"), Metric("b", expr="a * 2")])
    with pytest.raises(ValueError, match="a -> b -> a"):
        broken.query(["a"])


def test_validation_reports_each_problem(spark):
    model = MetricModel(
        "m",
        spark.createDataFrame([(1,)], "v int"),
        (Measure("good", "sum", "v"), Measure("bad", "sum", "nothing"), Measure("odd", "median", "v")),
        (Dimension("v"), Dimension("gone")),
    )
    layer = MetricLayer([model], [Metric("m1", measure="missing"), Metric("m2", expr="m1 + m3")])
    verdict = {(r.kind, r.name): (r.valid, r.rows) for r in layer.validate(spark).collect()}
    assert verdict[("measure", "good")] == (True, 1)
    bad = {k for k, (valid, _) in verdict.items() if not valid}
    assert bad == {("measure", "bad"), ("measure", "odd"), ("dimension", "gone"), ("metric", "m1"), ("metric", "m2")}


def test_catalogue_comes_from_the_definitions(spark, layer):
    listed = {r.name: (r.type, r.source) for r in layer.catalogue(spark).collect()}
    assert listed["revenue"] == ("simple", "amount") and listed["per_visit"] == ("derived", "revenue / visitors")


def test_entity_duplicates(layer):
    assert rows(entity_duplicates(layer.models["sales"], "store")) == [("x", 2)]


def test_fill_keeps_what_lies_outside_the_spine(spark):
    rows = [("2024-01-05", 1.0), ("2024-03-05", 2.0), ("2023-12-31", 4.0), (None, 8.0)]
    frame = spark.createDataFrame(rows, "d string, v double").withColumn("d", F.col("d").cast("date"))
    model = MetricModel("m", frame, (Measure("v", "sum", "v", exact=2),), (Dimension("d", "time"),))
    layer = MetricLayer([model], [Metric("v", measure="v")])
    out = layer.query(["v"], ["metric_time__month"], spine=time_spine(spark, "2024-01-01", "2024-04-01")).collect()
    got = {r[0] and str(r[0]): r.v for r in out}
    assert got == {"2024-01-01": 1.0, "2024-02-01": None, "2024-03-01": 2.0, "2023-12-01": 4.0, None: 8.0}
