"""Requests answered from stored roll-ups give what the facts give, and do not read the facts."""

from __future__ import annotations

import datetime as dt
import random
from dataclasses import replace

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from tessera.operators import rollups, semantic
from tessera.operators.semantic import Field, Join, SemanticModel, SemanticQuery
from tessera.plans import retail, tables

FOLDER = "/root/testdata/sf0.001"
ROWS = "id long, at timestamp_ntz, shop int, kind string, amount double, odd double"


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(3)
    start = dt.datetime(2023, 12, 20, 5)
    rows = [
        (k, None if k % 50 == 0 else start + dt.timedelta(hours=draw.randrange(24 * 90)), draw.choice([1, 2, 3, None, 9]),
         draw.choice(["a", "b", None]), None if k % 31 == 0 else round(draw.uniform(-50, 50), 2), draw.uniform(-1, 1))
        for k in range(2000)
    ]
    shops = spark.createDataFrame([(1, "north", "x"), (2, "south", "x"), (3, None, "y")], "id int, name string, zone string")
    stores = SemanticModel.from_frame("shops", shops, primary_key=["id"])
    return SemanticModel(
        "sales", spark.createDataFrame(rows, ROWS),
        fields=(Field("id", primary_key=True), Field("at"), Field("shop"), Field("kind"), Field("amount", exact=2), Field("odd")),
        joins=(Join("shops", stores, "shop", "id"),), time_dimension="at",
    )


MEASURES = ["amount:avg", "amount:max", "amount:min", "*:count", "odd:max", "kind:count"]


@pytest.fixture(scope="module")
def stored(model, tmp_path_factory):
    path = lambda name: str(tmp_path_factory.mktemp(name) / "r")
    return [
        rollups.store(model, SemanticQuery.of(MEASURES, ["at__day", "kind", "shops.name"]), path("days")),
        rollups.store(model, SemanticQuery.of(["amount:sum", "*:count"], ["at__month", "kind"]), path("months")),
        rollups.store(model, SemanticQuery.of(["amount:sum"], ["at__week", "shops.zone"], ["kind = 'a'"]), path("weeks")),
    ]


def rows_of(df):
    return sorted((tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


CASES = [
    (0, dict(measures=["amount:avg"], dimensions=["at__month", "shops.name"])),
    (0, dict(measures=["amount:sum / *:count", "odd:max"], dimensions=["at__week"], filters=["kind = 'a'", "shops.name <> 'south'"])),
    (0, dict(measures=["amount:max", "amount:min"], having=["amount_max > 0"])),
    (0, dict(measures=["cumsum(*:count)"], dimensions=["at__day"])),
    (0, dict(measures=["kind:count"], dimensions=["at__year", "kind"])),
    (1, dict(measures=["amount:sum", "*:count"], dimensions=["at__quarter"])),
    (1, dict(measures=["change(amount:sum)"], dimensions=["at__month"], filters=["kind IS NULL"])),
    (1, dict(measures=["amount:sum"], dimensions=["kind"], order=["-amount_sum"], limit=2)),
    (1, dict(measures=["*:count"], dimensions=["at__month", "kind"], sets=[["at__month"], ["kind"], []])),
    (2, dict(measures=["amount:sum"], dimensions=["at__week", "shops.zone"], filters=["kind = 'a'"])),
    (2, dict(measures=["amount:sum"], filters=["kind = 'a'", "shops.zone = 'x'"])),
    (None, dict(measures=["amount:sum"], dimensions=["at__month", "shops.zone"])),  # weeks do not tell months
    (None, dict(measures=["amount:sum"], filters=["at > '2024-01-01'"])),  # days do not tell times
    (None, dict(measures=["odd:sum"])),
    (None, dict(measures=["amount:sum"], dimensions=["shop"])),
    (None, dict(measures=["amount:sum"], dimensions=["at"])),
]


@pytest.mark.parametrize(("chosen", "request_"), CASES)
def test_same_as_the_facts(model, stored, chosen, request_):
    query = SemanticQuery.of(**request_)
    found = rollups.choose(query, stored)
    assert found is (None if chosen is None else stored[chosen])
    assert rows_of(rollups.answer(model, query, stored)) == rows_of(semantic.run(model, query))


def test_the_facts_are_not_read(spark):
    df = retail.rollup_by_month(spark, FOLDER)
    assert "orders.parquet" not in plan_of(df) and "rollup-days" in plan_of(df)
    # Its days are there, but only months hold the region.
    assert "rollup-months" in plan_of(retail.rollup_by_region(spark, FOLDER))


def test_refresh_reads_and_writes_the_changed_periods(spark, tmp_path):
    model = tables.orders(spark, FOLDER)
    query = SemanticQuery.of(["order_total:sum", "*:count"], ["ordered_at__day", "ordered_at__month"])
    first = rollups.store(model, query, str(tmp_path / "r"), "ordered_at__month")
    later = model.frame.where(F.year("o_orderdate") < 1996).unionByName(model.frame.where(F.month("o_orderdate") == 1))
    changed = replace(model, frame=later)
    one = rollups.refresh(replace(first, model=changed), ["1996-01-01", "1996-02-01"])
    got = {(r[0], r[1]) for r in rollups.answer(changed, SemanticQuery.of(["*:count"], ["ordered_at__month"]), [one]).select("ordered_at__month", "count").collect()}
    before = {r[0]: r[1] for r in model.frame.groupBy(F.trunc("o_orderdate", "month")).count().collect()}
    january = dt.date(1996, 1, 1)
    want = {k: n for k, n in before.items() if k not in (january, dt.date(1996, 2, 1))}
    fresh = later.where(F.trunc("o_orderdate", "month") == january).count()
    assert got == set(want.items()) | ({(january, fresh)} if fresh else set())
    with pytest.raises(ValueError, match="partitioned"):
        rollups.refresh(replace(first, partition=None), ["1996-01-01"])


def test_refused(model, tmp_path):
    with pytest.raises(ValueError, match="whole groups"):
        rollups.store(model, SemanticQuery.of(["*:count"], ["kind"], having=["count > 1"]), str(tmp_path / "r"))
    with pytest.raises(ValueError, match="not among the dimensions"):
        rollups.store(model, SemanticQuery.of(["*:count"], ["kind"]), str(tmp_path / "r"), "at__day")
    with pytest.raises(ValueError, match="not among the dimensions"):
        SemanticQuery.of(["*:count"], ["kind"], sets=[["shop"]])


def test_cuts_take_one_scan_and_one_exchange(spark):
    from tessera.plans import exposure

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        orders = tables.orders(spark, FOLDER)
        asked = SemanticQuery.of(["order_total:sum"], ["priority", "status"], sets=[["priority"], ["status"], []])
        plan = plan_of(semantic.run(orders, asked))
        assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1
        assert plan_of(exposure.exposure_cuts(spark, FOLDER)).count("orders.parquet") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_nothing_stored_of_nothing(spark, tmp_path):
    empty = SemanticModel.from_frame("e", spark.createDataFrame([], "k string, v double"))
    kept = rollups.store(empty, SemanticQuery.of(["v:sum", "*:count"], ["k"]), str(tmp_path / "r"))
    whole = SemanticQuery.of(["v:sum", "*:count"])
    assert rollups.choose(whole, [kept]) is kept
    assert rows_of(rollups.answer(empty, whole, [kept])) == rows_of(semantic.run(empty, whole))
