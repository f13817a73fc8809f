"""Stored roll-ups that answer requests over a semantic model.

A roll-up keeps states, not results: sums, counts, lowest and highest values per group, from which coarser
groups are merged, so that an average by month from stored days is the average and not one of averages. A
request is answered by the smallest roll-up that covers it, else from the facts. It is covered if

* every dimension is stored as it is, or in a grain from which its own can be told (weeks from days only);
* every state that its measures need is stored (an average's sum and count also serve ``sum`` and ``count``);
* the roll-up's own filters are among the request's, and what the others read is stored without a grain.

Results equal those of :func:`tessera.operators.semantic.run`, having, order, limit, formulas and
running totals included. Null keys are groups like any other, an empty table gives what the facts would.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import formulas
from tessera.functions.dates import truncate
from tessera.operators import semantic
from tessera.operators.aggregates import Aggregate, aggregate
from tessera.operators.semantic import Dimension, SemanticModel, SemanticQuery
from tessera.sources.catalog import refresh_model, save_model

#: The grains that can be told from a stored one.
COARSER = {
    "day": ("day", "week", "month", "quarter", "year"),
    "week": ("week",),
    "month": ("month", "quarter", "year"),
    "quarter": ("quarter", "year"),
    "year": ("year",),
}

#: No period of a grain has more days.
_LONGEST = {"day": 1, "week": 7, "month": 31, "quarter": 92, "year": 366}


@dataclass(frozen=True)
class Rollup:
    """A stored aggregate of ``model``. ``query`` is the request that made it, ``rows`` its size when it was written."""

    model: SemanticModel
    query: SemanticQuery
    frame: DataFrame
    path: str
    rows: int
    partition: str | None = None


def _terms(query: SemanticQuery) -> list[formulas.Term]:
    parsed = [formulas.parse(m.formula, m.name) for m in query.measures]
    return list(dict.fromkeys(t for f in parsed for t in f.terms))


def _aggregate_of(model: SemanticModel, term: formulas.Term) -> Aggregate:
    return aggregate(term.aggregate, None if term.column == "*" else model.field(term.column).exact)


def _state_name(term: formulas.Term, state: str) -> str:
    """States are stored by column, so that several aggregates share them."""
    column = "rows" if term.column == "*" else f"of {term.column}"
    return f"{column}: {state}"


def _states(model: SemanticModel, terms: Iterable[formulas.Term]) -> dict[str, tuple[formulas.Term, str]]:
    """Stored name -> (a term that needs it, its state)."""
    return {_state_name(t, s): (t, s) for t in terms for s in _aggregate_of(model, t).states}


def _stored(model: SemanticModel, query: SemanticQuery, extra: Sequence[str] = ()) -> DataFrame:
    """One row of states per group of the request, the filters ``extra`` applied besides."""
    wanted = replace(query, filters=(*query.filters, *extra), having=(), order=(), limit=None, sets=None)
    grouped = semantic.states(model, wanted)
    names = _states(model, _terms(query))
    return grouped.select(
        *[F.col(f"`{d.alias}`") for d in query.dimensions],
        *[F.col(f"`{t.alias}__{s}`").alias(name) for name, (t, s) in names.items()],
    )


def store(model: SemanticModel, query: SemanticQuery, path: str, partition: str | None = None) -> Rollup:
    """Aggregate the facts once and keep the states under ``path``, by partitions of the dimension named ``partition``."""
    if query.having or query.limit or query.sets is not None:
        raise ValueError("a roll-up keeps whole groups: no having, limit or sets")
    if partition is not None and partition not in {d.alias for d in query.dimensions}:
        raise ValueError(f"{partition!r} is not among the dimensions")
    frame = save_model(_stored(model, query), path, [partition] if partition else [])
    return Rollup(model, query, frame, path, frame.count(), partition)


def refresh(rollup: Rollup, values: Iterable) -> Rollup:
    """Work out these periods (or keys) of the partitioning dimension anew, and leave all other partitions alone."""
    if rollup.partition is None:
        raise ValueError("only a partitioned roll-up can be refreshed in part")
    values = list(values)
    dimension = next(d for d in rollup.query.dimensions if d.alias == rollup.partition)
    extra = []
    if "." not in dimension.name and dimension.grain and values and None not in values:
        # Facts of other periods are not aggregated, nor read where their files tell the time.
        days = [dt.date.fromisoformat(str(v)[:10]) for v in values]
        extra = [f"{dimension.name} >= '{min(days)}'", f"{dimension.name} < '{max(days) + dt.timedelta(days=_LONGEST[dimension.grain])}'"]
    frame = refresh_model(_stored(rollup.model, rollup.query, extra), rollup.path, rollup.partition, values)
    return replace(rollup, frame=frame, rows=frame.count())


def _source(dimension: Dimension, rollup: Rollup) -> Dimension | None:
    """The stored dimension that tells this one: the same if there is one, else the one of the fewest groups."""
    same = [d for d in rollup.query.dimensions if d.name == dimension.name]
    fit = [d for d in same if d.grain == dimension.grain]
    fit += sorted((d for d in same if d.grain and dimension.grain in COARSER[d.grain]), key=lambda d: len(COARSER[d.grain]))
    fit += [d for d in same if d.grain is None and dimension.grain]
    return fit[0] if fit else None


def _rest(query: SemanticQuery, rollup: Rollup) -> list[Column] | None:
    """Conditions still to be met by stored rows; None if the roll-up cannot tell them."""
    if not set(rollup.query.filters) <= set(query.filters):
        return None
    plain = {d.name for d in rollup.query.dimensions if d.grain is None}
    conditions = []
    for text in query.filters:
        if text in rollup.query.filters:
            continue
        condition, read = semantic.resolve(rollup.model, text)
        if not read <= plain:
            return None
        conditions.append(condition)
    return conditions


def covers(rollup: Rollup, query: SemanticQuery) -> bool:
    stored = _states(rollup.model, _terms(rollup.query))
    return (
        all(_source(d, rollup) for d in query.dimensions)
        and set(_states(rollup.model, _terms(query))) <= set(stored)
        and _rest(query, rollup) is not None
    )


def choose(query: SemanticQuery, rollups: Iterable[Rollup]) -> Rollup | None:
    """The smallest roll-up that covers the request."""
    return min((r for r in rollups if covers(r, query)), key=lambda r: r.rows, default=None)


def answer(model: SemanticModel, query: SemanticQuery, rollups: Sequence[Rollup] = (), decimals: bool = False) -> DataFrame:
    """The request's result, from the smallest roll-up of the model that covers it or else from the facts."""
    chosen = choose(query, [r for r in rollups if r.model is model])
    if chosen is None:
        return semantic.run(model, query, decimals)
    parsed = [formulas.parse(m.formula, m.name) for m in query.measures]
    how = {t: _aggregate_of(model, t) for t in _terms(query)}
    # Filters name columns as the model does, a joined one by its path.
    plain = {d.alias: semantic.carried_name(d.name) for d in chosen.query.dimensions if d.grain is None}
    rows = chosen.frame.withColumnsRenamed(plain)
    for condition in _rest(query, chosen):
        rows = rows.where(condition)
    keys = []
    for d in query.dimensions:
        source = _source(d, chosen)
        column = F.col(f"`{plain.get(source.alias, source.alias)}`")
        keys.append((column if source.grain == d.grain else truncate(column, d.grain)).alias(d.alias))
    held = {t: {s: F.col(f"`{_state_name(t, s)}`") for s in how[t].states} for t in how}
    merged = [merge(held[t][s]).alias(f"{t.alias}__{s}") for t in how for s, (_, merge) in how[t].states.items()]
    return semantic.settle(semantic.grouped(rows, keys, merged, query), model, query, parsed, how, decimals)


@dataclass
class Rollups:
    """A model with its stored roll-ups, asked like a catalogue."""

    model: SemanticModel
    stored: list[Rollup]

    def query(self, request: Mapping) -> DataFrame:
        return answer(self.model, SemanticQuery.of(**request), self.stored)
