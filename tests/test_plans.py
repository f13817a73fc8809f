"""What the plans of the registered queries must not contain, and what their scans read."""

from __future__ import annotations

import re

import pytest
from compare import plan_of

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for module in driver.OWN for name, query in module.QUERIES.items()}


@pytest.fixture
def wide_plans(spark):
    """Plans in full, with nothing small enough to broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxPlanStringLength": "1000000",
        "spark.sql.maxMetadataStringLength": "10000",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins_and_no_python(wide_plans, name):
    plan = plan_of(QUERIES[name](wide_plans, FOLDER))
    for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("measure_sum", {"o_orderstatus", "o_totalprice"}),
        ("completeness", {"doc_id", "lang", "quality", "toxic"}),
        ("dq_duplicates", {"l_orderkey", "l_linenumber"}),
        ("top_k_stores", {"o_custkey", "o_totalprice", "c_custkey", "c_nationkey", "n_nationkey", "n_name"}),
    ],
)
def test_scans_read_only_what_is_needed(wide_plans, name, columns):
    plan = plan_of(QUERIES[name](wide_plans, FOLDER))
    read = {c.split(":")[0] for found in re.findall(r"ReadSchema: struct<([^>]*)>", plan) for c in found.split(",")}
    assert read == columns


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("due_within_n_days", "LessThan(o_orderdate"),
        ("filter_range", "GreaterThan(o_totalprice,50.0)"),
        ("rating_at_or_below", "In(c_mktsegment"),
        ("retained_rows", "GreaterThanOrEqual(o_orderdate"),
    ],
)
def test_filters_reach_the_scan(wide_plans, name, pushed):
    assert pushed in plan_of(QUERIES[name](wide_plans, FOLDER))


def test_latency_reads_two_columns_of_the_log(wide_plans, monkeypatch):
    from tessera.operators import traces
    from tessera.session import materialise

    plans = []
    monkeypatch.setattr(traces, "materialise", lambda df, label: plans.append(plan_of(df)) or materialise(df, label))
    QUERIES["trace_latency"](wide_plans, FOLDER)
    scans = [found for plan in plans for found in re.findall(r"events.parquet.*ReadSchema: struct<([^>]*)>", plan)]
    assert scans and {c.split(":")[0] for found in scans for c in found.split(",")} == {"event_type", "value"}


def test_leaf_edges_are_not_shuffled_by_their_parent(spark, monkeypatch):
    """The few inner nodes are written, and small enough to be sent to the edges."""
    from tessera.operators import ontology

    rows = [(f"leaf{k}", f"top{k % 3}") for k in range(20_000)] + [(f"top{k}", "root") for k in range(3)]
    edges = spark.createDataFrame(rows, "child string, parent string").repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "65536")
    try:
        plan = plan_of(ontology.closure(edges))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [parent" in plan and not re.search(r"hashpartitioning\(parent", plan)
