"""Named metrics over declared measures, grouped by declared dimensions at any time grain."""

from __future__ import annotations

import ast
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import formulas
from tessera.functions.dates import GRAINS, truncate
from tessera.operators.aggregates import AGGREGATES, Aggregate, aggregate
from tessera.operators.semantic import order_and_limit
from tessera.sources.spine import periods

METRIC_TIME = "metric_time"


@dataclass(frozen=True)
class Measure:
    """An aggregate over an expression; ``latest`` sums the rows of the newest date only.

    ``exact`` is the number of decimals of a double that holds an amount, to be summed exactly.
    """

    name: str
    agg: str
    expr: str
    exact: int | None = None

    def value(self) -> Column:
        return F.expr(self.expr)

    def aggregate(self) -> Aggregate:
        return aggregate("sum" if self.agg == "latest" else self.agg, self.exact)


@dataclass(frozen=True)
class Dimension:
    name: str
    kind: str = "categorical"
    expr: str | None = None
    grain: str = "day"


@dataclass(frozen=True)
class MetricModel:
    name: str
    frame: DataFrame
    measures: tuple[Measure, ...]
    dimensions: tuple[Dimension, ...]
    entities: dict[str, str] = field(default_factory=dict)
    time_dimension: str | None = None

    def time(self) -> Dimension:
        for dim in self.dimensions:
            if dim.kind == "time" and self.time_dimension in (None, dim.name):
                return dim
        raise ValueError(f"model {self.name!r} declares no time dimension")


@dataclass(frozen=True)
class Metric:
    """``simple`` names a measure; ``derived`` is arithmetic over other metrics."""

    name: str
    label: str = ""
    description: str = ""
    measure: str | None = None
    expr: str | None = None

    @property
    def kind(self) -> str:
        return "simple" if self.measure else "derived"


@dataclass(frozen=True)
class _Group:
    """A requested grouping, and how each model computes it."""

    alias: str
    name: str
    grain: str | None


class MetricLayer:
    def __init__(self, models: Sequence[MetricModel], metrics: Sequence[Metric]):
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}
        self._measures = {measure.name: (model, measure) for model in models for measure in model.measures}

    def metric(self, name: str) -> Metric:
        if name not in self.metrics:
            raise ValueError(f"unknown metric {name!r}; metrics: {', '.join(self.metrics)}")
        return self.metrics[name]

    def base_metrics(self, name: str, above: tuple[str, ...] = ()) -> list[Metric]:
        """Simple metrics below ``name``, in the order they are first needed."""
        if name in above:
            raise ValueError(f"metric cycle: {' -> '.join([*above, name])}")
        metric = self.metric(name)
        if metric.measure:
            return [metric]
        below = [self.base_metrics(n, (*above, name)) for n in formulas.names(formulas.parse(metric.expr).tree)]
        return list({m.name: m for part in below for m in part}.values())

    def dimension_names(self) -> list[str]:
        found: dict[str, None] = {}
        for model in self.models.values():
            if any(d.kind == "time" for d in model.dimensions):
                declared = GRAINS.index(model.time().grain)
                found.update(dict.fromkeys(f"{METRIC_TIME}__{g}" for g in GRAINS[declared:]))
            found.update(dict.fromkeys(d.name for d in model.dimensions))
            found.update(dict.fromkeys(model.entities))
        return list(found)

    def query(
        self,
        metrics: Iterable[str],
        group_by: Iterable[str] | None = None,
        order_by: Iterable[str] | None = None,
        limit: int | None = None,
        where: Iterable[str] | None = None,
        spine: DataFrame | None = None,
    ) -> DataFrame:
        """One column per group and metric. With ``spine``, every period of it appears."""
        wanted = list(metrics)
        groups = [self._group(g) for g in group_by or ()]
        base = {m.name: m for name in wanted for m in self.base_metrics(name)}
        by_model: dict[str, list[Metric]] = {}
        for metric in base.values():
            if metric.measure not in self._measures:
                raise ValueError(f"metric {metric.name!r} refers to unknown measure {metric.measure!r}")
            by_model.setdefault(self._measures[metric.measure][0].name, []).append(metric)

        parts = [
            self._aggregate(self.models[model], members, groups, tuple(where or ()))
            for model, members in by_model.items()
        ]
        combined = self._combine(parts, groups)
        if spine is not None:
            combined = self._fill(combined, groups, spine)
        aliases = [g.alias for g in groups]
        exact = [n for n in base if formulas.odd_name(n) in combined.columns]
        out = combined.select(*[F.col(a) for a in aliases], *[self._value(n, exact).alias(n) for n in wanted])
        order = [(o.lstrip("-"), o.startswith("-")) for o in order_by or ()]
        return order_and_limit(out, order, limit or None, aliases)

    def _group(self, text: str) -> _Group:
        """``metric_time__month``, ``entity``, or ``entity_name__dimension``."""
        name, _, last = text.rpartition("__")
        grain = last if name and last in GRAINS else None
        base = name if grain else text
        if base == METRIC_TIME:
            return _Group(text, METRIC_TIME, grain)
        qualifier, _, short = base.rpartition("__")
        entities = {e for m in self.models.values() for e in m.entities}
        if qualifier in entities:
            base = short
        known = {d.name for m in self.models.values() for d in m.dimensions} | entities
        if base not in known:
            raise ValueError(f"unknown dimension {text!r}; dimensions: {', '.join(self.dimension_names())}")
        return _Group(text, base, grain)

    def _group_column(self, model: MetricModel, group: _Group) -> Column:
        if group.name == METRIC_TIME:
            dim = model.time()
        elif group.name in model.entities:
            return F.expr(model.entities[group.name]).alias(group.alias)
        else:
            found = [d for d in model.dimensions if d.name == group.name]
            if not found:
                raise ValueError(f"model {model.name!r} cannot be grouped by {group.alias!r}")
            dim = found[0]
        col = F.expr(dim.expr or f"`{dim.name}`")
        if dim.kind != "time":
            return col.alias(group.alias)
        grain = group.grain or dim.grain
        if GRAINS.index(grain) < GRAINS.index(dim.grain):
            raise ValueError(f"{dim.name!r} is declared by {dim.grain}; {grain} is finer")
        return truncate(col, grain).alias(group.alias)

    def _aggregate(
        self, model: MetricModel, members: list[Metric], groups: list[_Group], where: tuple[str, ...]
    ) -> DataFrame:
        """The model's measures per group, from one pass over its facts.

        ``latest`` measures need the day as a further key; the others are then taken per day
        first and merged.
        """
        facts = reduce(lambda df, text: df.where(F.expr(text)), where, model.frame)
        keys = [self._group_column(model, g) for g in groups]
        aliases = [F.col(g.alias) for g in groups]
        named = [(m.name, self._measures[m.measure][1]) for m in members]
        plain = [(n, m) for n, m in named if m.agg != "latest"]
        newest = [(n, m) for n, m in named if m.agg == "latest"]
        states = [s for n, m in named for s in m.aggregate().partial(m.value(), n)]
        if newest:
            time = model.time()
            day = truncate(F.expr(time.expr or f"`{time.name}`"), "day").alias("__day")
            daily = facts.groupBy(*keys, day).agg(*states)
            merged = [s for n, m in plain for s in m.aggregate().merge(n)]
            last = [
                F.max_by(column, "__day").alias(column)
                for n, m in newest
                for column in (f"{n}__{state}" for state in m.aggregate().states)
            ]
            grouped = daily.groupBy(*aliases).agg(*merged, *last)
        else:
            grouped = facts.groupBy(*keys).agg(*states)
        finished = [m.aggregate().finish(n) for n, m in named]
        odd = [F.col(f"`{formulas.odd_name(n)}`") for n, m in named if m.aggregate().exact]
        return grouped.select(*aliases, *finished, *odd)

    def _combine(self, parts: list[DataFrame], groups: list[_Group]) -> DataFrame:
        """Lay the parts side by side on their group keys, null keys matching null keys.

        Stacking and regrouping does in one shuffle of aggregated rows what a chain of
        null-safe full joins would do in several.
        """
        if len(parts) == 1:
            return parts[0]
        keys = [g.alias for g in groups]
        values = [c for part in parts for c in part.columns if c not in keys]
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return stacked.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])

    def _fill(self, combined: DataFrame, groups: list[_Group], spine: DataFrame) -> DataFrame:
        """The spine's periods beside the aggregate, which is already small.

        Facts before or after the spine, and those without a date, keep their rows.
        """
        times = [g for g in groups if g.name == METRIC_TIME]
        if len(times) != 1:
            raise ValueError(f"period fill needs one {METRIC_TIME} grouping")
        time = times[0]
        grain = time.grain or "day"
        return periods(spine, grain).withColumnRenamed("period", time.alias).join(combined, time.alias, "full")

    def _value(self, name: str, exact: list[str]) -> Column:
        metric = self.metric(name)
        tree = ast.Name(name) if metric.measure else _expanded(formulas.parse(metric.expr).tree, self)
        return formulas.settled(tree, exact)

    def catalogue(self, spark: SparkSession) -> DataFrame:
        """Name, label, type, description and dimensions of every metric."""
        dims = self.dimension_names()
        rows = [(m.name, m.label, m.kind, m.description, m.measure or m.expr, dims) for m in self.metrics.values()]
        return spark.createDataFrame(
            rows, "name string, label string, type string, description string, source string, dimensions array<string>"
        )

    def problems(self) -> list[tuple[str, str, str]]:
        """(kind, name, message) of every definition that does not resolve; nothing is run."""
        found = []
        for model in self.models.values():
            empty = model.frame.limit(0)
            expressions = [("dimension", d.name, d.expr or f"`{d.name}`") for d in model.dimensions]
            expressions += [("entity", n, e) for n, e in model.entities.items()]
            for measure in model.measures:
                if measure.agg not in AGGREGATES and measure.agg != "latest":
                    found.append(("measure", measure.name, f"unknown aggregate {measure.agg!r}"))
                expressions.append(("measure", measure.name, measure.expr))
            for kind, name, text in expressions:
                try:
                    _ = empty.select(F.expr(text)).schema
                except AnalysisException as error:
                    found.append((kind, name, str(error).splitlines()[0]))
        for metric in self.metrics.values():
            try:
                for base in self.base_metrics(metric.name):
                    if base.measure not in self._measures:
                        raise ValueError(f"unknown measure {base.measure!r}")
            except ValueError as error:
                found.append(("metric", metric.name, str(error)))
        return found

    def validate(self, spark: SparkSession) -> DataFrame:
        """Every definition with its verdict and, for measures, the rows that feed it."""
        broken = {(kind, name): message for kind, name, message in self.problems()}
        frames = []
        for model in self.models.values():
            usable = [m for m in model.measures if ("measure", m.name) not in broken]
            if usable:
                filled = model.frame.agg(*[F.count(F.expr(m.expr)).alias(m.name) for m in usable])
                rows = [
                    F.struct(F.lit("measure").alias("kind"), F.lit(m.name).alias("name"), F.col(m.name).alias("rows"))
                    for m in usable
                ]
                frames.append(filled.select(F.inline(F.array(*rows))))
        others = [("dimension", d.name) for m in self.models.values() for d in m.dimensions]
        others += [("entity", n) for m in self.models.values() for n in m.entities]
        others += [("measure", n) for n in self._measures if ("measure", n) in broken]
        others += [("metric", n) for n in self.metrics]
        frames.append(spark.createDataFrame([(k, n, None) for k, n in others], "kind string, name string, rows bigint"))
        everything = reduce(DataFrame.unionByName, frames)
        if not broken:
            return everything.withColumn("valid", F.lit(True)).withColumn("message", F.lit(None).cast("string"))
        notes = spark.createDataFrame([(*k, v) for k, v in broken.items()], "kind string, name string, message string")
        return everything.join(notes, ["kind", "name"], "left").withColumn("valid", F.col("message").isNull())


def _expanded(tree: ast.expr, layer: MetricLayer) -> ast.expr:
    """A derived metric's arithmetic with every metric name replaced by its own value."""
    class Expand(ast.NodeTransformer):
        def visit_Name(self, node: ast.Name) -> ast.expr:
            metric = layer.metric(node.id)
            return node if metric.measure else self.visit(formulas.parse(metric.expr).tree)

    return Expand().visit(tree)


def entity_duplicates(model: MetricModel, entity: str) -> DataFrame:
    """Values of a declared primary entity that more than one row carries."""
    keyed = model.frame.groupBy(F.expr(model.entities[entity]).alias(entity))
    return keyed.agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
