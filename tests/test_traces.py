"""Trace logs."""

from __future__ import annotations

import random
import re

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from tessera.operators import traces
from tessera.session import materialise
from tessera.sources.traces import TYPED_TRACE_SCHEMA, read_trace

# Lines of our own in the form of a trace.
LINES = """
{"event":"run.start","question":"How many orders are open?","contract":"orders","timestamp":"2001-08-01T08:00:00Z"}
{"event":"run.step","stop_reason":"tool_use","latency_ms":120,"timestamp":"2001-08-01T08:00:01Z"}
{"event":"step.args","raw_args":{"query":"SELECT 1"},"timestamp":"2001-08-01T08:00:01Z"}
{"event":"step.call","tool":"orders","sql":"SELECT 2","timestamp":"2001-08-01T08:00:02Z"}
{"event":"step.result","rows":1,"data":[{"open":731,"share":48.7}],"timestamp":"2001-08-01T08:00:02Z"}
{"event":"run.answer","latency_ms":95,"lineage_source":["orders.parquet"],"timestamp":"2001-08-01T08:00:03Z"}
""".strip()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "trace.jsonl").write_text(LINES)
    return str(tmp_path)


def test_batch(spark, folder):
    trace = read_trace(spark, folder)
    assert trace.count() == 6
    assert [r.sql for r in traces.events(trace, "step.call").collect()] == ["SELECT 2"]
    assert [r.source for r in traces.lineage(trace).where("source is not null").collect()] == ["orders.parquet"]
    record = traces.result_rows(trace).first().record
    assert record == {"open": "731", "share": "48.7"}
    asked = trace.where("raw_args is not null").select(traces.query_argument(F.col("raw_args")).alias("q"))
    assert asked.first().q == "SELECT 1"


def test_typed_records(spark, tmp_path):
    """Nested values and numbers are read back with their types."""
    payloads = [
        '[{"open":731,"share":48.5,"by":{"region":"EU","top":[{"id":9007199254740993}]}},{"open":"many","late":true}]',
        '{"open":3}', "[]", "null", '[null,{"by":{"region":null}}]', "17",
    ]
    lines = [f'{{"event":"step.result","rows":{k},"data":{p}}}' for k, p in enumerate(payloads)]
    (tmp_path / "trace.jsonl").write_text("\n".join([*lines, '{"event":"run.start"}']))
    fields = {
        "open": ("$.open", "bigint"), "share": ("$.share", "double"), "region": ("$.by.region", "string"),
        "top": ("$.by.top[0].id", "bigint"), "late": ("$.late", "boolean"), "by": ("$.by", "map<string,variant>"),
    }
    trace = read_trace(spark, str(tmp_path), TYPED_TRACE_SCHEMA)
    found = traces.typed_rows(trace, fields)
    assert dict(found.dtypes)["top"] == "bigint" and dict(found.dtypes)["share"] == "double"
    rows = found.select("rows", "position", "open", "share", "region", "top", "late", F.map_keys("by").alias("by")).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[:2]) == [
        (0, 0, 731, 48.5, "EU", 9007199254740993, None, ["region", "top"]),
        (0, 1, None, None, None, None, True, None),
        (1, 0, 3, None, None, None, None, None),
        (4, 0, None, None, None, None, None, None),
        (4, 1, None, None, None, None, None, ["region"]),
        (5, 0, None, None, None, None, None, None),
    ]
    with pytest.raises(ValueError, match="position"):
        traces.typed_rows(trace, {"position": ("$.x", "int")})


def test_argument_fallback(spark):
    given = ['{"sql":"a","query":"b"}', '{"sql":"","query":"b"}', '{"x":"c","sql":""}', "{}", "oops", None]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, g string")
    out = traces.tool_arguments(df, "g", "q").orderBy("i")
    assert [r.q for r in out.collect()] == ["a", "b", "c", None, None, None]


def test_quantiles_are_exact(spark):
    numpy = pytest.importorskip("numpy")
    rng = random.Random(8)
    values = {
        "hot": [round(rng.expovariate(0.02), 2) for _ in range(3000)] + [7.25] * 1500,
        "few": [1.0, 2.5],
        "one": [-3.75],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 12) for _ in range(2000)],
        "dense": [rng.random() for _ in range(2000)],
    }
    values[None] = [3.0, 1.0, 2.0]
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    marks = (0.0, 0.25, 0.5, 0.95, 1.0)
    found = traces.latency(df, "k", "v", marks).collect()
    empty = [r for r in found if r.k == "empty"]
    assert len(found) == len(values) + 1 and empty[0].n == 0 and empty[0].p50_latency is None
    for row in found:
        if row.k == "empty":
            continue
        expected = numpy.quantile(values[row.k], marks)
        assert [row[f"p{round(q * 100)}_latency"] for q in marks] == pytest.approx(list(expected))
        assert row.n == len(values[row.k]) and row.max_latency == max(values[row.k])
        assert row.avg_latency == pytest.approx(numpy.mean(values[row.k]))


def test_values_are_never_shuffled(spark, monkeypatch):
    """Every reading of the log is reduced to bins or parts before its exchange."""
    plans = []
    monkeypatch.setattr(traces, "materialise", lambda df, label: plans.append(plan_of(df)) or materialise(df, label))
    df = spark.createDataFrame([("a", float(x)) for x in range(100)], "k string, v double")
    plans.append(plan_of(traces.latency(df, "k", "v", (0.5,))))
    keys = [found for plan in plans for found in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert keys and not any(re.search(r"\bv#", k) for k in keys)
