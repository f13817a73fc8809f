"""Trace logs: events, tool arguments, lineage and latency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialise


def events(trace: DataFrame, *kinds: str, column: str = "event") -> DataFrame:
    return trace.where(F.col(column).isin(*kinds))


def tool_arguments(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the query in a tool call's JSON arguments.

    The parsed map is a column of its own for a moment, so that each line is parsed once.
    """
    parsed = df.withColumn("__given", F.from_json(column, "map<string,string>"))
    return parsed.withColumn(out, query_argument(F.col("__given"))).drop("__given")


def query_argument(given: Column) -> Column:
    """``sql``, else ``query``, else the first value; empty texts count as missing."""
    first = F.get(F.map_values(given), F.lit(0))
    return F.coalesce(F.nullif(given["sql"], F.lit("")), F.nullif(given["query"], F.lit("")), first)


def lineage(trace: DataFrame) -> DataFrame:
    """One row per event and source it names; events without sources are kept."""
    return trace.select("event", "timestamp", F.explode_outer("lineage_source").alias("source"))


def result_rows(trace: DataFrame) -> DataFrame:
    """One row per result record in a trace line."""
    return trace.select("event", "timestamp", "rows", F.posexplode("data").alias("position", "record"))


def typed_rows(trace: DataFrame, fields: Mapping[str, tuple[str, str]], column: str = "data") -> DataFrame:
    """One row per result record of a ``variant`` column, with ``fields``: name -> (path, type).

    Records may be nested; a field is read with its own type. It is null where the record has no such path, or a
    value there that its type cannot hold. A payload that is not a list is one record. Lines without a payload,
    or with an empty list or JSON's null, give no rows.
    """
    given = F.when(~F.is_variant_null(column), F.col(column))
    listed = F.coalesce(F.try_variant_get(given, "$", "array<variant>"), F.when(given.isNotNull(), F.array(given)))
    records = trace.select("event", "timestamp", "rows", F.posexplode(listed).alias("position", "record"))
    read = {name: F.try_variant_get("record", path, kind) for name, (path, kind) in fields.items()}
    clash = set(read) & {"event", "timestamp", "rows", "position", "record"}
    if clash:
        raise ValueError(f"field names in use: {', '.join(sorted(clash))}")
    return records.withColumns(read).drop("record")


#: Equal parts that a range of values is cut into by one reading of the log.
_PARTS = 1 << 20


def latency(trace: DataFrame, event: str, value: str, quantiles: Sequence[float]) -> DataFrame:
    """Count, average, maximum and exact quantiles of a latency per event kind.

    The first reading reduces the rows to logarithmic bins, some millions at the very most, from which
    all but the quantiles come. Each further reading counts within the few ranges that hold a wanted
    rank, see :func:`_narrowed`. Every reading is reduced before its shuffle; none shuffles values. The null
    kind is a kind, and kinds without values have n = 0.
    """
    rows = trace.select(F.col(event).alias("kind"), F.col(value).cast("double").alias("v"))
    bin_of = F.signum("v") * F.floor(F.log2(F.abs("v") + 1) * 4096)
    bins = rows.groupBy("kind", bin_of.alias("bin")).agg(
        F.count("v").alias("n"), F.sum("v").alias("sum"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    bins = materialise(bins, "latency-bins")
    stats = bins.groupBy("kind").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum("sum"), F.sum("n")).alias("avg_latency"), F.max("hi").alias("max_latency")
    )
    at = [F.lit(float(q)) * (F.col("n") - 1) for q in quantiles]
    wanted = [
        F.struct(F.lit(i).alias("q"), x.alias("at"), rank.cast("long").alias("rank"))
        for i, x in enumerate(at)
        for rank in (F.floor(x), F.ceil(x))
    ]
    asked = materialise(stats.where("n > 0").select("kind", F.inline(F.array(*wanted))), "latency-ranks")
    ranks = asked.select("kind", "rank").distinct()
    ordered = _ranked(bins.where("n > 0"), ["kind"], "bin", F.lit(0))
    same = F.col("kind").eqNullSafe(F.col("k"))
    hit = ordered.join(ranks.withColumnRenamed("kind", "k"), same)
    exact = _narrowed(rows, _holding(hit).select("kind", "rank", "lo", "hi", "first"))
    ends = asked.join(exact.select(F.col("kind").alias("k"), F.col("rank").alias("r"), "v"), same & (F.col("rank") == F.col("r")))
    marks = ends.groupBy("kind", "q", "at").agg(F.min("v").alias("below"), F.max("v").alias("above"))
    mark = F.col("below") + (F.col("above") - F.col("below")) * (F.col("at") - F.floor("at"))
    names = [f"p{round(q * 100)}_latency" for q in quantiles]
    marks = marks.groupBy(F.col("kind").alias("k")).agg(
        *[F.max(F.when(F.col("q") == i, mark)).alias(n) for i, n in enumerate(names)]
    )
    return stats.join(marks, same, "left").select(F.col("kind").alias(event), "n", "avg_latency", "max_latency", *names)


def _narrowed(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """(kind, rank, v): the value at each rank, from ranges (kind, rank, lo, hi, first) that hold it.

    The ranges are a few for each kind. The log is read again, each range in a million equal parts
    that are counted where the rows are, until the part with the rank holds a single value.
    """
    found = []
    while True:
        hits = materialise(hits, "latency-ranges")
        found.append(hits.where("lo = hi").select("kind", "rank", F.col("lo").alias("v")))
        wide = hits.where("lo < hi")
        if wide.isEmpty():
            return reduce(DataFrame.unionByName, found)
        ranges = wide.select(F.col("kind").alias("k"), "rank", "lo", "hi", "first")
        inside = rows.join(ranges, F.col("kind").eqNullSafe(F.col("k")) & F.col("v").between(F.col("lo"), F.col("hi")))
        # Halves first, so that the width of a range is finite.
        part = F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * _PARTS)
        parts = inside.groupBy("kind", "rank", part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("first").alias("base")
        )
        hits = _holding(_ranked(parts, ["kind", "rank"], "part", F.col("base"))).select("kind", "rank", "lo", "hi", "first")


def _ranked(rows: DataFrame, by: Sequence[str], order: str, base: Column) -> DataFrame:
    """Add the ``first`` and ``last`` rank each row stands for, counted from ``base``."""
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    last = base + F.sum("n").over(upto) - 1
    return rows.withColumn("last", last).withColumn("first", F.col("last") - F.col("n") + 1)


def _holding(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("rank").between(F.col("first"), F.col("last")))
