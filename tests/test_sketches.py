"""Stored quantile sketches, merged to coarser periods."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from tessera.functions.dates import truncate
from tessera.operators import sketches

KIND = {"kind": "kind"}
KEYS = KIND | {"day": "day"}
MARKS = (0.0, 0.25, 0.5, 0.95, 1.0)


def off_by(values, q, answer):
    """How far ``answer`` is from the values that have rank ``q``, as a share of the count."""
    below, upto = sum(v < answer for v in values) / len(values), sum(v <= answer for v in values) / len(values)
    return max(0.0, below - q, q - upto)


@pytest.fixture(scope="module")
def rows():
    rng, first = random.Random(11), dt.date(2024, 1, 25)
    out = [("hot", first + dt.timedelta(days=k % 12), rng.expovariate(0.01)) for k in range(40000)]
    out += [("hot", first, 7.25)] * 8000
    out += [(None, first + dt.timedelta(days=k % 3), float(k)) for k in range(50)]
    return out + [("few", first, 2.5), ("few", None, -1.0), ("few", first, None), ("none", first, None), ("odd", first, float("nan"))]


@pytest.fixture
def frame(spark, rows):
    return spark.createDataFrame(rows, "kind string, day date, v double").repartition(6)


def test_months_from_stored_days(spark, rows, frame, tmp_path):
    stored = sketches.store(frame, KEYS, "v", str(tmp_path / "days"))
    months = sketches.merge(stored, KIND | {"month": truncate(F.col("day"), "month")})
    found = {(r.kind, r.month and str(r.month)[:7]): r for r in sketches.quantiles(months, MARKS).collect()}
    values = {}
    for kind, day, v in rows:
        kept = values.setdefault((kind, day and str(day)[:7]), [])
        if v is not None and v == v:
            kept.append(v)
    assert set(found) == set(values)
    for key, vs in values.items():
        row = found[key]
        assert row.n == len(vs)
        if not vs:
            assert row.p50 is None
            continue
        assert (row.p0, row.p100) == (min(vs), max(vs))
        for q in MARKS:
            assert off_by(vs, q, row[f"p{q * 100:g}"]) <= 2 * sketches.rank_error()


def test_merged_sketches_merge_again(rows, frame):
    months = sketches.merge(sketches.sketches(frame, KEYS, "v"), KIND | {"month": truncate(F.col("day"), "month")})
    row = sketches.quantiles(sketches.merge(months, {}), (0.5, 0.999)).first()
    values = [v for _, _, v in rows if v is not None and v == v]
    assert row.n == len(values)
    assert off_by(values, 0.5, row.p50) <= 2 * sketches.rank_error()
    assert off_by(values, 0.999, row["p99.9"]) <= 2 * sketches.rank_error()


def test_facts_are_not_read_again(spark, frame, tmp_path):
    facts, days = str(tmp_path / "facts"), str(tmp_path / "days")
    frame.write.parquet(facts)
    stored = sketches.store(spark.read.parquet(facts), KEYS, "v", days)
    plan = plan_of(sketches.quantiles(sketches.merge(stored, KIND), (0.95,)))
    assert "/days]" in plan and "/facts]" not in plan
    plan = plan_of(sketches.sketches(spark.read.parquet(facts), KEYS, "v"))
    # Sketched where the rows are, then merged in the one exchange.
    assert "partial_kll" in plan and plan.count("Exchange") == 1


def test_a_late_day_rewrites_its_partition(spark, frame, tmp_path):
    path, day = str(tmp_path / "days"), dt.date(2024, 1, 26)
    sketches.store(frame, KEYS, "v", path, "day")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("*.parquet")}
    late = frame.unionByName(spark.createDataFrame([("few", day, 9.0)], frame.schema))
    stored = sketches.refresh(late, KEYS, "v", path, "day", [day])
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("*.parquet")}
    kept = {p for p in before if f"day={day}" not in str(p)}
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert {(r.kind, r.n, r.p50) for r in sketches.quantiles(stored.where(F.col("day") == day), (0.5,)).collect()} >= {("few", 1, 9.0)}


def test_empty(frame):
    none = frame.limit(0)
    assert sketches.quantiles(sketches.sketches(none, KEYS, "v"), (0.5,)).count() == 0
    row = sketches.quantiles(sketches.merge(sketches.sketches(none, KEYS, "v"), {}), (0.5,)).first()
    assert (row.n, row.p50) == (0, None)


def test_wrong_quantiles(frame):
    made = sketches.sketches(frame, KIND, "v")
    for wrong in ((0.5, 0.5), (1.5,)):
        with pytest.raises(ValueError):
            sketches.quantiles(made, wrong)
