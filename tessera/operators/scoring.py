"""Keyword rubrics over answers: flags, totals, matrix, and what each answer newly passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import preview, size_label
from tessera.operators import running
from tessera.session import materialise

_FOLDED = "__folded"


@dataclass(frozen=True)
class Criterion:
    """Passed by an answer that contains any of the phrases; case is folded unless it matters."""

    name: str
    phrases: tuple[str, ...]
    case_sensitive: bool = False

    def test(self, answer: str) -> Column:
        text = F.col(answer if self.case_sensitive else _FOLDED)
        found = F.lit(False)
        for phrase in self.phrases:
            found = found | text.contains(phrase)
        return found


# The rubric of the capital question. A bare "141" passes, wherever it stands.
CAPITAL_RUBRIC = (
    Criterion("CET1 ratio value (14.83%)", ("14.83",), case_sensitive=True),
    Criterion(
        "Regulation cited (Basel III Art. 92)", ("article 92", "art. 92", "art 92", "92(1)", "article 92(1)")
    ),
    Criterion("Owner: Treasury Risk Team", ("treasury risk team",)),
    Criterion(
        "Freshness SLA (5 business days)", ("5 business day", "five business day", "p5d", "within 5 business")
    ),
    Criterion(
        "Negative headroom → Art. 141",
        ("article 141", "141", "dividend", "buyback", "bonus restriction", "distribution restriction"),
    ),
)


def flag_names(rubric: Sequence[Criterion]) -> list[str]:
    return [f"c{i}" for i in range(1, len(rubric) + 1)]


def flags(
    df: DataFrame, keys: Sequence[str | Column], answer: str, rubric: Sequence[Criterion], error: Column | None = None
) -> DataFrame:
    """One boolean column per criterion. A failed or missing answer passes nothing.

    The text is read in place and dropped, so that only keys and flags go on.
    """
    usable = F.col(answer).isNotNull() if error is None else F.col(answer).isNotNull() & ~error
    kept = [F.col(k) if isinstance(k, str) else k for k in keys]
    folded = df.select(*kept, F.col(answer), usable.alias("usable"), F.lower(answer).alias(_FOLDED))
    tested = [
        (F.col("usable") & F.coalesce(c.test(answer), F.lit(False))).alias(n)
        for c, n in zip(rubric, flag_names(rubric), strict=True)
    ]
    return folded.select(*[c for c in folded.columns if c not in (answer, _FOLDED, "usable")], "usable", *tested)


def total(rubric: Sequence[Criterion]) -> Column:
    score = F.lit(0)
    for name in flag_names(rubric):
        score = score + F.col(name).cast("int")
    return score


def band(score: Column, out_of: int) -> Column:
    """Green when everything is passed, yellow from 60 percent, red below."""
    return F.when(score == out_of, "green").when(score >= out_of * 0.6, "yellow").otherwise("red")


def long_form(flagged: DataFrame, keys: Sequence[str], rubric: Sequence[Criterion]) -> DataFrame:
    """(keys, criterion, passed) rows."""
    pairs = [
        F.struct(F.lit(c.name).alias("criterion"), F.col(n).alias("passed"))
        for c, n in zip(rubric, flag_names(rubric), strict=True)
    ]
    return flagged.select(*keys, F.inline(F.array(*pairs)))


#: A matrix with more columns than this is no table any more; its cells are.
MAX_AGENTS = 1000


def matrix_cells(flagged: DataFrame, agent: str, rubric: Sequence[Criterion]) -> DataFrame:
    """(agent, criterion, passed): whether any answer of the agent passes, for any number of agents.

    The flags are reduced per agent first; only one row per agent is unfolded. A null agent is one of its own.
    """
    reduced = flagged.groupBy(agent).agg(*[F.max(n).alias(n) for n in flag_names(rubric)])
    return long_form(reduced, [agent], rubric)


def presence_cells(cells: DataFrame, row: str, agent: str, present: str) -> DataFrame:
    """(row, agent, cell): stored flags, such as layer by agent: 1 where any flag is set, null where all are null."""
    return cells.groupBy(row, agent).agg(F.max(F.col(present).cast("int")).alias("cell"))


def matrix(flagged: DataFrame, agent: str, rubric: Sequence[Criterion]) -> DataFrame:
    """Criterion by agent: 1 where any answer of the agent passes. A view of ``matrix_cells``, see ``spread``."""
    cells = materialise(matrix_cells(flagged, agent, rubric), "cells")
    return spread(cells.withColumn("passed", F.col("passed").cast("int")), "criterion", agent, "passed")


def presence(cells: DataFrame, row: str, agent: str, present: str) -> DataFrame:
    """Stored flags as a matrix: null where there is none. A view of ``presence_cells``, see ``spread``."""
    return spread(materialise(presence_cells(cells, row, agent, present), "cells"), row, agent, "cell")


def spread(cells: DataFrame, row: str, agent: str, cell: str) -> DataFrame:
    """Written cells as a matrix with a column for each of at most ``MAX_AGENTS`` agents, a null one's named ``null``."""
    agents = [r[0] for r in cells.select(agent).distinct().limit(MAX_AGENTS + 1).collect()]
    if len(agents) > MAX_AGENTS:
        raise ValueError(f"over {MAX_AGENTS} agents do not fit in columns; use the cells")
    if None in agents and "null" in agents:
        raise ValueError("an agent is named 'null' beside one without a name; use the cells")
    return cells.groupBy(row).pivot(agent, sorted(agents, key=lambda a: (a is None, a))).agg(F.max(cell))


def _listed(rubric: Sequence[Criterion], test) -> Column:
    """Names of the criteria that pass ``test``, in alphabetical order, without a shuffle."""
    named = [F.when(test(n), F.lit(c.name)) for c, n in zip(rubric, flag_names(rubric), strict=True)]
    return F.array_sort(F.array_compact(F.array(*named)))


def still_missing(rubric: Sequence[Criterion]) -> Column:
    return _listed(rubric, lambda n: ~F.col(n))


def newly_unlocked(
    flagged: DataFrame, run: Sequence[str], seq: str, rubric: Sequence[Criterion], block: int = 4096
) -> DataFrame:
    """Criteria an answer passes that the last successful answer before it did not.

    The first successful answer unlocks all it passes. Failed answers unlock nothing and are
    not compared against. Runs of any length are cut into blocks of ``block`` steps. The flags
    are written out first: they are read twice, and the texts behind them should not be.
    """
    names = flag_names(rubric)
    state = F.when(F.col("usable"), F.struct(*names))
    step = F.floor(F.col(seq) / block)
    before = running.previous(materialise(flagged, "flags"), state, "__before", order=seq, by=run, block=step)
    fresh = _listed(rubric, lambda n: F.col(n) & ~F.coalesce(F.col(f"__before.{n}"), F.lit(False)))
    return before.withColumn("newly_unlocked", fresh).drop("__before")


def context_size(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    chars = F.length(text)
    return df.select(*keys, chars.cast("bigint").alias("chars"), size_label(chars).alias("size"))


def size_by_agent(df: DataFrame, agent: str, text: str) -> DataFrame:
    """How much text each agent holds, beside the matrix of what it gets right."""
    sizes = df.groupBy(agent).agg(F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0)).alias("chars"))
    return sizes.select(agent, "chars", size_label(F.col("chars")).alias("size"))


def answer_preview(df: DataFrame, keys: Sequence[str], text: str, width: int = 400) -> DataFrame:
    """The opening of each answer, and whether more follows."""
    return df.select(*keys, preview(F.col(text), width).alias("preview"), (F.length(text) > width).alias("truncated"))
