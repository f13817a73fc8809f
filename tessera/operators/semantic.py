"""Semantic models and the queries over them.

A model names the columns of a table, the models it joins to, and its time dimension. A query
names measures, dimensions (dotted through joins), filters, an order and a limit. ``run`` turns
both into one lazy DataFrame: only the joins a query refers to are made, each target once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import formulas
from tessera.functions.dates import GRAINS, truncate
from tessera.operators import running
from tessera.operators.aggregates import Aggregate, aggregate
from tessera.session import materialise

#: Which dimensions a row of a cut does not have, one bit each, the last dimension's the lowest.
GROUPING_ID = "grouping_id"

_QUOTED = re.compile(r"('(?:[^']|'')*')")


@dataclass(frozen=True)
class Field:
    """A model column. ``exact`` is the number of decimals of a double that holds an amount:
    it is then summed exactly."""

    name: str
    expr: str | None = None
    hidden: bool = False
    primary_key: bool = False
    exact: int | None = None

    def column(self) -> Column:
        return F.expr(self.expr or f"`{self.name}`").alias(self.name)


@dataclass(frozen=True)
class Join:
    """A many-to-one join to ``target``.

    ``preaggregate`` marks a target that grows with the data. Facts are then summed per
    foreign key before the join, so that a key holding a third of the facts arrives at the
    join as one row per group and not as a hot partition. Targets that stay small need no such
    step: Spark broadcasts them once it has seen their size.
    """

    name: str
    model: SemanticModel | Callable[[], SemanticModel]
    foreign_key: str
    key: str
    preaggregate: bool = False

    @cached_property
    def target(self) -> SemanticModel:
        """The joined model; one given as a function is made when a query first needs it."""
        return self.model if isinstance(self.model, SemanticModel) else self.model()


@dataclass(frozen=True)
class SemanticModel:
    name: str
    frame: DataFrame
    fields: tuple[Field, ...]
    joins: tuple[Join, ...] = ()
    time_dimension: str | None = None

    @classmethod
    def from_frame(
        cls,
        name: str,
        frame: DataFrame,
        primary_key: Iterable[str] = (),
        hidden: Iterable[str] = (),
        exact: Mapping[str, int] | None = None,
        rename: Mapping[str, str] | None = None,
        joins: Sequence[Join] = (),
        time_dimension: str | None = None,
    ) -> SemanticModel:
        """Model of a table as its schema shows it; the first date column is the time dimension."""
        keys, concealed, money, names = set(primary_key), set(hidden), dict(exact or {}), dict(rename or {})
        fields = tuple(
            Field(
                names.get(f.name, f.name),
                f"`{f.name}`",
                hidden=f.name in concealed,
                primary_key=f.name in keys,
                exact=money.get(f.name),
            )
            for f in frame.schema.fields
        )
        times = [names.get(f.name, f.name) for f in frame.schema.fields if _is_time(f.dataType)]
        return cls(name, frame, fields, tuple(joins), time_dimension or (times[0] if times else None))

    def field(self, name: str) -> Field:
        for item in self.fields:
            if item.name == name:
                return item
        raise ValueError(f"model {self.name!r} has no column {name!r}; it has {', '.join(self.visible())}")

    def join(self, name: str) -> Join:
        for item in self.joins:
            if item.name == name:
                return item
        known = ", ".join(j.name for j in self.joins) or "none"
        raise ValueError(f"model {self.name!r} has no join {name!r}; joins: {known}")

    def visible(self) -> list[str]:
        """Columns offered to callers: neither hidden nor primary key."""
        return [f.name for f in self.fields if not f.hidden and not f.primary_key]

    def logical(self) -> DataFrame:
        """The table under the model's own column names."""
        return self.frame.select(*[f.column() for f in self.fields])


def _is_time(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.DateType | T.TimestampType | T.TimestampNTZType)


@dataclass(frozen=True)
class Measure:
    formula: str
    name: str | None = None


@dataclass(frozen=True)
class Dimension:
    """``path.to.column``, optionally with a time grain: ``ordered_at__month``."""

    name: str
    grain: str | None = None

    @property
    def alias(self) -> str:
        flat = self.name.replace(".", "_")
        return f"{flat}__{self.grain}" if self.grain else flat

    @classmethod
    def read(cls, item: str | Mapping | Dimension) -> Dimension:
        if isinstance(item, Dimension):
            return item
        if isinstance(item, Mapping):
            given = cls.read(item["name"])
            return replace(given, grain=item.get("granularity") or given.grain)
        name, _, grain = item.rpartition("__")
        return cls(name, grain) if name and grain in GRAINS else cls(item)


@dataclass(frozen=True)
class SemanticQuery:
    measures: tuple[Measure, ...]
    dimensions: tuple[Dimension, ...] = ()
    filters: tuple[str, ...] = ()
    having: tuple[str, ...] = ()
    order: tuple[tuple[str, bool], ...] = ()
    limit: int | None = None
    #: Cuts by some of the dimensions each, all from one aggregate; the result then has a column ``grouping_id``.
    sets: tuple[tuple[str, ...], ...] | None = None

    @classmethod
    def of(
        cls,
        measures: Iterable[str | Mapping | Measure],
        dimensions: Iterable[str | Mapping | Dimension] | None = None,
        filters: Iterable[str] | None = None,
        having: Iterable[str] | None = None,
        order: Iterable[Mapping | str] | None = None,
        limit: int | None = None,
        sets: Iterable[Iterable[str | Mapping | Dimension]] | None = None,
    ) -> SemanticQuery:
        """Normalise a request: bare strings are accepted, an order without dimensions and
        empty filters are dropped, and a limit of zero or null means none."""
        dims = tuple(Dimension.read(d) for d in dimensions or ())
        cuts = None if sets is None else tuple(tuple(Dimension.read(d).alias for d in cut) for cut in sets)
        strange = sorted({a for cut in cuts or () for a in cut} - {d.alias for d in dims})
        if strange:
            raise ValueError(f"not among the dimensions: {', '.join(strange)}")
        return cls(
            measures=tuple(_read_measure(m) for m in measures),
            dimensions=dims,
            filters=tuple(f for f in filters or () if f and f.strip()),
            having=tuple(f for f in having or () if f and f.strip()),
            order=tuple(_read_order(o) for o in order or ()) if dims else (),
            limit=limit or None,
            sets=cuts,
        )


def _read_measure(item: str | Mapping | Measure) -> Measure:
    if isinstance(item, Measure):
        return item
    return Measure(item) if isinstance(item, str) else Measure(item["formula"], item.get("name"))


def _read_order(item: Mapping | str) -> tuple[str, bool]:
    """(column, descending); ``-column`` is short for descending."""
    if isinstance(item, str):
        return _order_name(item.lstrip("-")), item.startswith("-")
    return _order_name(item["column"]), str(item.get("direction", "asc")).lower() == "desc"


def _order_name(column: str) -> str:
    return column.removeprefix("*:").replace(":", "_").replace(".", "_")


@dataclass
class _Paths:
    """Joined models a query needs, with the columns it reads from each."""

    root: SemanticModel
    columns: dict[tuple[str, ...], set[str]] = field(default_factory=dict)

    def need(self, dotted: str) -> str:
        """Record a column; return the flat name under which the query carries it."""
        *path, column = dotted.split(".")
        model = self.root
        for depth, step in enumerate(path, start=1):
            model = model.join(step).target
            self.columns.setdefault(tuple(path[:depth]), set())
        model.field(column)
        if path:
            self.columns[tuple(path)].add(column)
        return _flat(path, column)


def _flat(path: Sequence[str], column: str) -> str:
    return "__".join([*path, column])


@dataclass(frozen=True)
class _Filter:
    """A condition over flat names; ``carried`` are root columns a joined condition reads too."""

    condition: Column
    joined: bool
    carried: tuple[str, ...]


def _resolve_filter(text: str, paths: _Paths) -> _Filter:
    joined = False

    def swap(found: re.Match) -> str:
        nonlocal joined
        if found.group(0).split(".")[0] not in {j.name for j in paths.root.joins}:
            return found.group(0)
        joined = True
        return f"`{paths.need(found.group(0))}`"

    parts = [
        part if part.startswith("'") else re.sub(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+", swap, part)
        for part in _QUOTED.split(text)
    ]
    words = {w for part in parts if not part.startswith("'") for w in re.findall(r"\w+", part)}
    carried = tuple(f.name for f in paths.root.fields if joined and f.name in words)
    return _Filter(F.expr("".join(parts)), joined, carried)


def run(model: SemanticModel, query: SemanticQuery, decimals: bool = False) -> DataFrame:
    """The query as a lazy DataFrame, one column per dimension and measure.

    Sums of exact fields are doubles, or with ``decimals`` decimals for further sums; an amount that no
    decimal can hold (NaN, an infinity) then makes its group's sum null.
    """
    parsed = [formulas.parse(m.formula, m.name) for m in query.measures]
    outputs = [f.name for f in parsed] + [d.alias for d in query.dimensions] + [GROUPING_ID] * (query.sets is not None)
    twice = sorted({name for name in outputs if outputs.count(name) > 1})
    if twice:
        raise ValueError(f"several columns would be named {', '.join(twice)}; give the measures names")
    return settle(states(model, query), model, query, parsed, _how(model, _terms(parsed)), decimals)


def _terms(parsed: Sequence[formulas.Formula]) -> list[formulas.Term]:
    return list(dict.fromkeys(t for f in parsed for t in f.terms))


def _how(model: SemanticModel, terms: Sequence[formulas.Term]) -> dict[formulas.Term, Aggregate]:
    return {t: aggregate(t.aggregate, None if t.column == "*" else model.field(t.column).exact) for t in terms}


def resolve(model: SemanticModel, text: str) -> tuple[Column, set[str]]:
    """A filter over carried names, and the dotted names of the columns it reads."""
    paths = _Paths(model)
    found = _resolve_filter(text, paths)
    parts = [part for part in _QUOTED.split(text) if not part.startswith("'")]
    dotted = {name for part in parts for name in re.findall(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+", part)}
    dotted = {name for name in dotted if name.split(".")[0] in {j.name for j in model.joins}}
    words = {w for part in parts for w in re.findall(r"(?<![\w.])\w+(?![\w.])", part)}
    return found.condition, dotted | {f.name for f in model.fields if f.name in words}


def carried_name(dotted: str) -> str:
    """The flat name under which a query carries a column."""
    *path, column = dotted.split(".")
    return _flat(path, column)


def states(model: SemanticModel, query: SemanticQuery) -> DataFrame:
    """One row per group with the states of each term, named ``<term>__<state>``, before anything is finished."""
    terms = _terms([formulas.parse(m.formula, m.name) for m in query.measures])
    paths = _Paths(model)
    dims = [(d, paths.need(d.name)) for d in query.dimensions]
    filters = [_resolve_filter(f, paths) for f in query.filters]

    facts = model.logical()
    for item in filters:
        if not item.joined:
            facts = facts.where(item.condition)

    values = {t: F.lit(1) if t.column == "*" else F.col(t.column) for t in terms}
    how = _how(model, terms)

    own = {flat_name(d, flat): _dimension_column(d, flat) for d, flat in dims if "." not in d.name}
    own |= {name: F.col(name) for item in filters for name in item.carried}
    links = {}
    for path in paths.columns:
        key = model.join(path[0]).foreign_key
        # A foreign key that is itself asked for serves as the link, so that one shuffle does for both.
        links[path] = key if len(path) == 1 and key in own else "__fk_" + "_".join(path)
    for path, link in links.items():
        if len(path) == 1 and link not in own:
            own[link] = F.col(model.join(path[0]).foreign_key)

    inputs = {t: F.col(f"__in_{t.alias}") for t in terms}
    taken = [values[t].alias(f"__in_{t.alias}") for t in terms]
    facts = facts.select(*[column.alias(name) for name, column in own.items()], *taken)
    merged = False
    for path in sorted(paths.columns, key=len):
        if _join_at(model, path).preaggregate:
            facts, merged = _collapse(facts, inputs, how, merged), True
        facts = _join_target(facts, model, path, paths, links)
    for item in filters:
        if item.joined:
            facts = facts.where(item.condition)

    names = [flat_name(d, flat) for d, flat in dims]
    keys = [
        (F.col(n) if "." not in d.name else _dimension_column(d, flat)).alias(d.alias)
        for (d, flat), n in zip(dims, names, strict=True)
    ]
    return grouped(facts, keys, _states(inputs, how, merged), query)


def grouped(facts: DataFrame, keys: list[Column], states: list[Column], query: SemanticQuery) -> DataFrame:
    """One aggregate; with grouping sets, rows are taken once and each cut is a row beside the others'."""
    if query.sets is None:
        return facts.groupBy(*keys).agg(*states) if states else facts.select(*keys).distinct()
    # Keys under their own names, out of the way of the facts' columns.
    named = [f"__key_{k}" for k in range(len(keys))]
    facts = facts.select("*", *[key.alias(n) for key, n in zip(keys, named, strict=True)])
    of = dict(zip([d.alias for d in query.dimensions], named, strict=True))
    cuts = [[F.col(of[a]) for a in cut] for cut in query.sets]
    out = facts.groupingSets(cuts, *[F.col(n) for n in named]).agg(*states, F.grouping_id().alias(GROUPING_ID))
    return out.withColumnsRenamed({n: a for a, n in of.items()})


def settle(
    groups: DataFrame,
    model: SemanticModel,
    query: SemanticQuery,
    parsed: list[formulas.Formula],
    how: dict[formulas.Term, Aggregate],
    decimals: bool,
) -> DataFrame:
    """Results from one row of states per group: finished aggregates, formulas, having, order and limit."""
    aliases = [d.alias for d in query.dimensions] + [GROUPING_ID] * (query.sets is not None)
    exact = [t.alias for t in how if how[t].exact]
    finished = [how[t].finish(t.alias) for t in how]
    odd = [F.col(f"`{formulas.odd_name(a)}`") for a in exact]
    out = groups.select(*[F.col(f"`{a}`") for a in aliases], *finished, *odd)

    out = _finish(out, model, query, parsed, aliases, exact, decimals)
    for condition in query.having:
        out = out.where(F.expr(condition))
    return order_and_limit(out, query.order, query.limit, aliases)


def _states(inputs: dict[formulas.Term, Column], how: dict[formulas.Term, Aggregate], merged: bool) -> list[Column]:
    """Aggregates over the facts, or over what an earlier step has made of them."""
    return [
        state
        for term, value in inputs.items()
        for state in (
            how[term].merge(term.alias)
            if merged
            else how[term].partial(value, term.alias)
        )
    ]


def _collapse(
    facts: DataFrame, inputs: dict[formulas.Term, Column], how: dict[formulas.Term, Aggregate], merged: bool
) -> DataFrame:
    """One row per combination of everything that is not a measure."""
    measured = {f"__in_{t.alias}" for t in inputs}
    measured |= {f"{t.alias}__{s}" for t in inputs for s in how[t].states}
    keys = [c for c in facts.columns if c not in measured]
    states = _states(inputs, how, merged)
    return facts.groupBy(*keys).agg(*states) if states else facts.select(*keys).distinct()


def _join_at(root: SemanticModel, path: Sequence[str]) -> Join:
    for step in path[:-1]:
        root = root.join(step).target
    return root.join(path[-1])


def flat_name(dimension: Dimension, flat: str) -> str:
    return f"{flat}__{dimension.grain}" if dimension.grain and "." not in dimension.name else flat


def _dimension_column(dimension: Dimension, flat: str) -> Column:
    return truncate(F.col(flat), dimension.grain) if dimension.grain else F.col(flat)


def _join_target(
    facts: DataFrame, root: SemanticModel, path: tuple[str, ...], paths: _Paths, links: dict[tuple[str, ...], str]
) -> DataFrame:
    """Left join of one target: its key, the columns read, and the links further on."""
    join = _join_at(root, path)
    onward = [p for p in paths.columns if len(p) == len(path) + 1 and p[: len(path)] == path]
    target = join.target.logical().select(
        F.col(join.key).alias("__pk"),
        *[F.col(c).alias(_flat(path, c)) for c in sorted(paths.columns[path])],
        *[F.col(join.target.join(p[-1]).foreign_key).alias(links[p]) for p in onward],
    )
    link = links[path]
    spent = [link] if link.startswith("__fk_") else []
    return facts.join(target, F.col(link) == F.col("__pk"), "left").drop("__pk", *spent)


def _finish(
    out: DataFrame,
    model: SemanticModel,
    query: SemanticQuery,
    parsed: list[formulas.Formula],
    aliases: list[str],
    exact: list[str],
    decimals: bool,
) -> DataFrame:
    """Apply the formulas' arithmetic, window calls included, to the aggregated columns.

    Window calls run over the decimals; from a sum with an odd part on, a running total is NaN.
    """
    extra: list[str] = []
    odd = [F.col(f"`{formulas.odd_name(a)}`").isNotNull().cast("int") for a in exact]

    def window(call: str, inner: Column) -> Column:
        nonlocal out
        time, rest, block = _time_axis(out, model, query, aliases)
        if block is not None and not extra:
            out = materialise(out, "series")  # blocks read it twice
        column = f"__{call}_{len(extra)}"
        extra.append(column)
        step = running.cumulative if call == "cumsum" else running.change
        out = step(out, inner, column, order=time, by=rest, block=block)
        if call == "cumsum" and odd and not decimals:
            out = step(out, F.greatest(F.lit(0), *odd), f"{column}_odd", order=time, by=rest, block=block)
            return F.when(F.col(f"{column}_odd") > 0, F.lit(float("nan"))).otherwise(F.col(column).cast("double"))
        return F.col(column)

    settle = formulas.to_column if decimals else lambda tree, window: formulas.settled(tree, exact, window)
    results = [(f.name, settle(f.tree, window)) for f in parsed]
    return out.select(*[F.col(f"`{a}`") for a in aliases], *[column.alias(name) for name, column in results])


def _time_axis(
    out: DataFrame, model: SemanticModel, query: SemanticQuery, aliases: list[str]
) -> tuple[str, list[str], Column | None]:
    """The dimension that orders a window call, the others, and the blocking it needs."""
    types = {f.name: f.dataType for f in out.schema.fields}
    times = [d for d in query.dimensions if d.grain or d.name == model.time_dimension]
    times = times or [d for d in query.dimensions if _is_time(types[d.alias])]
    if len(times) != 1:
        raise ValueError("cumsum() and change() need exactly one time dimension")
    time = times[0].alias
    rest = [a for a in aliases if a != time]
    by_calendar = isinstance(types[time], T.DateType)
    return time, rest, None if by_calendar else F.date_trunc("hour", F.col(time))


def order_and_limit(
    df: DataFrame, order: Sequence[tuple[str, bool]], limit: int | None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Sort with nulls last; ties are settled by the group keys, so that a limit is repeatable.

    A limit without an order takes the first groups by their keys.
    """
    if limit and not order:
        df = df.orderBy(*[_sort(c, False) for c in tiebreak or df.columns])
    if order:
        known = set(df.columns)
        for column, _ in order:
            if column not in known:
                raise ValueError(f"cannot order by {column!r}; columns: {', '.join(df.columns)}")
        chosen = [_sort(column, descending) for column, descending in order]
        used = {column for column, _ in order}
        df = df.orderBy(*chosen, *[_sort(c, False) for c in tiebreak if c not in used])
    return df.limit(limit) if limit else df


def _sort(column: str, descending: bool) -> Column:
    col = F.col(f"`{column}`")
    return col.desc_nulls_last() if descending else col.asc_nulls_last()


def describe(spark: SparkSession, model: SemanticModel) -> DataFrame:
    """What a caller may ask of a model: visible columns, join targets, time dimension."""
    types = {f.name: f.dataType.simpleString() for f in model.logical().schema.fields}
    rows = [("column", n, types[n], n == model.time_dimension) for n in model.visible()]
    rows += [("join", j.name, j.target.name, False) for j in model.joins]
    return spark.createDataFrame(rows, "kind string, name string, detail string, is_time_dimension boolean")


def duplicate_join_keys(model: SemanticModel, join_name: str) -> DataFrame:
    """Keys that occur more than once in a join target and would multiply the facts."""
    join = model.join(join_name)
    keyed = join.target.logical().groupBy(F.col(join.key).alias("key"))
    return keyed.agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def column_profile(model: SemanticModel) -> DataFrame:
    """Every column of an ingested table with its type, flags and filled rows, in one pass."""
    logical = model.logical()
    types = {f.name: f.dataType.simpleString() for f in logical.schema.fields}
    filled = logical.agg(*[F.count(F.col(f.name)).alias(f.name) for f in model.fields])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(types[f.name]).alias("data_type"),
            F.lit(not f.hidden and not f.primary_key).alias("visible"),
            F.lit(f.name == model.time_dimension).alias("is_time_dimension"),
            F.col(f.name).alias("filled_rows"),
        )
        for f in model.fields
    ]
    return filled.select(F.inline(F.array(*rows)))


def describe_live(model: SemanticModel) -> DataFrame:
    """``describe`` with the facts behind each entry: filled values of a column, matches of a join.

    Foreign keys are counted before they are looked up, so each key meets its target once.
    """
    logical = model.logical()
    types = {f.name: f.dataType.simpleString() for f in logical.schema.fields}
    visible = model.visible()
    entries = [
        F.struct(
            F.lit("column").alias("kind"),
            F.lit(n).alias("name"),
            F.lit(types[n]).alias("detail"),
            F.lit(n == model.time_dimension).alias("is_time_dimension"),
            F.col(n).alias("fact_rows"),
        )
        for n in visible
    ]
    out = logical.agg(*[F.count(n).alias(n) for n in visible]).select(F.inline(F.array(*entries)))
    for join in model.joins:
        keys = logical.groupBy(F.col(join.foreign_key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        target = join.target.logical().select(F.col(join.key).alias("k"))
        matched = keys.join(target, "k", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"))
        out = out.unionByName(
            matched.select(
                F.lit("join").alias("kind"),
                F.lit(join.name).alias("name"),
                F.lit(join.target.name).alias("detail"),
                F.lit(False).alias("is_time_dimension"),
                "fact_rows",
            )
        )
    return out
