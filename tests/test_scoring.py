"""Rubric flags, bands, sizes and what is newly passed."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from tessera.operators import scoring
from tessera.operators.scoring import CAPITAL_RUBRIC, Criterion

FULL = (
    "The ratio is 14.83% under Basel III Article 92(1)(a). Owner: TREASURY RISK TEAM, updated within 5 business days. "
    "Negative headroom triggers ARTICLE 141."
)


def test_capital_rubric(spark):
    answers = [
        (1, FULL, False),
        (2, "The ratio is 14.83.", False),
        (3, "Room 141", False),
        (4, None, False),
        (5, FULL, True),
        (6, "art 92 and five business day", False),
    ]
    df = spark.createDataFrame(answers, "i int, a string, failed boolean")
    flagged = scoring.flags(df, ["i"], "a", CAPITAL_RUBRIC, error=F.col("failed"))
    totals = {r.i: r.t for r in flagged.select("i", scoring.total(CAPITAL_RUBRIC).alias("t")).collect()}
    assert totals == {1: 5, 2: 1, 3: 1, 4: 0, 5: 0, 6: 2}


def test_bands(spark):
    df = spark.range(6).select(F.col("id").alias("n"), scoring.band(F.col("id"), 5).alias("b"))
    assert [r.b for r in df.orderBy("n").collect()] == ["red", "red", "red", "yellow", "yellow", "green"]


def _label(n: int) -> str:
    return "—" if n == 0 else f"{n}ch" if n < 1000 else f"{n / 1000:.1f}k"


def test_size_labels(spark):
    from tessera.functions.text import size_label

    df = spark.range(0, 30000, 1).unionByName(spark.createDataFrame([(1234567,), (10**9 + 50,)], "id bigint"))
    assert all(r.s == _label(r.id) for r in df.select("id", size_label(F.col("id")).alias("s")).collect())


def test_preview(spark):
    df = spark.createDataFrame([(1, "é" * 400), (2, "é" * 401)], "i int, t string")
    rows = {r.i: (len(r.preview), r.truncated) for r in scoring.answer_preview(df, ["i"], "t").collect()}
    assert rows == {1: (400, False), 2: (400, True)}


def test_matrix(spark):
    rubric = (Criterion("one", ("x",)), Criterion("two", ("Y",), case_sensitive=True))
    df = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", "y"), ("b", None), (None, "x")], "agent string, t string")
    cells = scoring.matrix(scoring.flags(df, ["agent"], "t", rubric), "agent", rubric).collect()
    assert {r.criterion: (r.a, r.b, r["null"]) for r in cells} == {"one": (1, 0, 1), "two": (1, 0, 0)}


def test_presence_of_stored_flags(spark):
    rows = [("contract", "a1", True), ("contract", "a2", False), ("ontology", "a2", True), ("contract", "a2", None), (None, "a1", False)]
    cells = scoring.presence(spark.createDataFrame(rows, "layer string, agent string, present boolean"), "layer", "agent", "present")
    assert {r.layer: (r.a1, r.a2) for r in cells.collect()} == {"contract": (1, 0), "ontology": (None, 1), None: (0, None)}
    sizes = scoring.size_by_agent(spark.createDataFrame([("a", "x" * 990), ("a", "y" * 20), ("b", None)], "g string, t string"), "g", "t")
    assert {r.g: (r.chars, r["size"]) for r in sizes.collect()} == {"a": (1010, "1.0k"), "b": (0, "—")}


def test_cells_for_any_number_of_agents(spark, monkeypatch):
    rubric = (Criterion("one", ("x",)),)
    rows = [(f"a{k}", "x" if k % 3 else "y") for k in range(12_000)] + [(None, "x"), ("null", "y")]
    flagged = scoring.flags(spark.createDataFrame(rows, "agent string, t string"), ["agent"], "t", rubric)
    cells = {r.agent: r.passed for r in scoring.matrix_cells(flagged, "agent", rubric).collect()}
    assert cells == {agent: text == "x" for agent, text in rows}
    with pytest.raises(ValueError, match="use the cells"):
        scoring.matrix(flagged, "agent", rubric)
    with pytest.raises(ValueError, match="named 'null'"):
        scoring.matrix(flagged.where("agent IS NULL OR agent = 'null'"), "agent", rubric)


def test_newly_unlocked_against_a_loop(spark):
    rubric = tuple(Criterion(c, (c,)) for c in "abcd")
    rng = random.Random(5)
    rows = []
    for run, length in ((0, 300), (1, 9), (2, 1)):
        rows += [(run, i, "".join(rng.sample("abcd", rng.randint(0, 4))), rng.random() < 0.3) for i in range(length)]
    expected, missing = {}, {}
    before: dict = {}
    for run, seq, answer, failed in rows:
        passed = set() if failed else set(answer)
        expected[run, seq] = sorted(passed - before.get(run, set()))
        missing[run, seq] = sorted(set("abcd") - passed)
        if not failed:
            before[run] = passed
    df = spark.createDataFrame(rows, "run int, seq int, t string, failed boolean")
    flagged = scoring.flags(df, ["run", "seq"], "t", rubric, error=F.col("failed"))
    for block in (4, 4096):
        out = scoring.newly_unlocked(flagged, ["run"], "seq", rubric, block=block)
        assert {(r.run, r.seq): r.newly_unlocked for r in out.collect()} == expected
    left = flagged.select("run", "seq", scoring.still_missing(rubric).alias("m")).collect()
    assert {(r.run, r.seq): r.m for r in left} == missing
