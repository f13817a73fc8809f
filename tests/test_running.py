"""Blocked windows give what plain windows give, a hot key included."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import running


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(11)
    rows = []
    for key, length in (("hot", 400), ("a", 30), ("b", 1), (None, 25)):
        steps = sorted(rng.sample(range(1000), length))
        rows += [(key, s, rng.choice([None, *range(-5, 6)])) for s in steps]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v int")


def result(df):
    return sorted((tuple(r) for r in df.select("k", "t", "out").collect()), key=repr)


@pytest.mark.parametrize("size", [1, 7, 64, 5000])
@pytest.mark.parametrize("step", [running.cumulative, running.previous, running.change])
def test_blocks_change_nothing(series, step, size):
    plain = step(series, F.col("v"), "out", order="t", by=["k"])
    blocked = step(series, F.col("v"), "out", order="t", by=["k"], block=F.floor(F.col("t") / size))
    assert result(blocked) == result(plain)


def test_without_groups(series):
    once = series.groupBy("t").agg(F.sum("v").alias("v")).withColumn("k", F.lit("all"))
    plain = running.cumulative(once, F.col("v"), "out", order="t")
    blocked = running.cumulative(once, F.col("v"), "out", order="t", block=F.floor(F.col("t") / 50))
    assert result(blocked) == result(plain)
