"""Concepts held as triples: description, hierarchy, synonyms and live values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numbers import percent_text
from tessera.operators.aggregates import Aggregate, aggregate
from tessera.session import materialise
from tessera.sources import triples as t


class Vocabulary:
    """Property names of the domain vocabulary below a base IRI."""

    def __init__(self, base: str):
        self.formula = base + "formula"
        self.minimum = base + "minimumRequirement"
        self.article = base + "basedOnArticle"
        self.governed_by = base + "governedBy"
        self.column = base + "columnMapping"
        self.unit = base + "unit"
        self.fixed_rate = base + "fixedRate"
        self.publisher = base + "publisher"
        self.effective = base + "effectiveDate"

    def concept_properties(self) -> dict[str, str]:
        return {
            "label": t.LABEL,
            "alt_label": t.ALT_LABEL,
            "definition": t.DEFINITION,
            "parent": t.SUBCLASS_OF,
            "formula": self.formula,
            "minimum": self.minimum,
            "article": self.article,
            "governed_by": self.governed_by,
            "column_name": self.column,
            "unit": self.unit,
            "fixed_rate": self.fixed_rate,
        }


def subjects(triples: DataFrame, kind: str) -> DataFrame:
    """Subjects of a type."""
    typed = triples.where((F.col("p") == t.RDF_TYPE) & (F.col("o") == kind))
    return typed.select("s").distinct()


def describe(triples: DataFrame, kind: str, properties: Mapping[str, str]) -> DataFrame:
    """One row per labelled subject of a type, one column per property.

    Where a property has several values the smallest is taken, so that the result does not
    depend on the order of the triples. One aggregate; a subject with very many triples is
    reduced before the shuffle.
    """
    wanted = triples.where(F.col("p").isin(t.RDF_TYPE, *properties.values()))
    typed = (F.col("p") == t.RDF_TYPE) & (F.col("o") == kind)
    values = [F.min(F.when(F.col("p") == p, F.col("o"))).alias(name) for name, p in properties.items()]
    rows = wanted.groupBy(F.col("s").alias("concept")).agg(F.max(typed).alias("__typed"), *values)
    return rows.where(F.col("__typed") & F.col("label").isNotNull()).drop("__typed")


def concepts(triples: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    return describe(triples, t.OWL_CLASS, vocabulary.concept_properties())


def regulations(triples: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    properties = {
        "label": t.LABEL,
        "definition": t.DEFINITION,
        "publisher": vocabulary.publisher,
        "effective": vocabulary.effective,
    }
    named = describe(triples, t.OWL_INDIVIDUAL, properties)
    return named.withColumn("effective", F.col("effective").try_cast("date")).withColumnRenamed("concept", "regulation")


def labels(triples: DataFrame) -> DataFrame:
    """One label per subject."""
    return triples.where(F.col("p") == t.LABEL).groupBy(F.col("s").alias("concept")).agg(F.min("o").alias("label"))


def linked_label(triples: DataFrame, predicate: str, out: str, kind: str = t.OWL_CLASS) -> DataFrame:
    """Per concept the label of what ``predicate`` points to; null where there is none.

    Labels are first reduced to the nodes pointed at and written out. Few targets are the rule,
    and then Spark, knowing the size, broadcasts them; should there be many, and one of them
    named by a third of all concepts, the adaptive skew join splits it.
    """
    own = describe(triples, kind, {"label": t.LABEL, "__to": predicate})
    targets = own.select(F.col("__to").alias("concept")).where(F.col("concept").isNotNull()).distinct()
    named = targets.join(labels(triples), "concept").select(F.col("concept").alias("__to"), F.col("label").alias(out))
    named = materialise(named, "target-labels")
    return own.join(named, "__to", "left").select("concept", "label", out)


def column_concepts(columns: DataFrame, triples: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Columns with the concept they are mapped to."""
    return columns.join(_mappings(triples, vocabulary), "column_name")


def unmapped_columns(columns: DataFrame, triples: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    return columns.join(_mappings(triples, vocabulary), "column_name", "left_anti")


def _mappings(triples: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    read = triples.where(F.col("p").isin(t.LABEL, vocabulary.column)).groupBy(F.col("s").alias("concept"))
    both = read.agg(
        F.min(F.when(F.col("p") == vocabulary.column, F.col("o"))).alias("column_name"),
        F.min(F.when(F.col("p") == t.LABEL, F.col("o"))).alias("label"),
    )
    return both.where(F.col("column_name").isNotNull() & F.col("label").isNotNull())


def subclass_edges(triples: DataFrame) -> DataFrame:
    """Direct (child, parent) pairs; a concept is not counted as its own parent."""
    edges = triples.where(F.col("p") == t.SUBCLASS_OF).select(F.col("s").alias("child"), F.col("o").alias("parent"))
    return edges.where(F.col("child") != F.col("parent"))


def _inner_edges(edges: DataFrame) -> DataFrame:
    """Edges whose child has children itself: what is left once the leaves are set aside."""
    parents = edges.select(F.col("parent").alias("child")).distinct()
    return materialise(edges.join(parents, "child", "left_semi").distinct(), "inner-edges")


def _leaf_parents(edges: DataFrame) -> DataFrame:
    """(child, parent) of the concepts without children that have exactly one parent."""
    inner = edges.select(F.col("parent").alias("child")).distinct()
    leaves = edges.join(inner, "child", "left_anti").groupBy("child")
    one = leaves.agg(F.min("parent").alias("parent"), F.max("parent").alias("other"))
    return materialise(one.where("parent = other").select("child", "parent"), "leaf-parents")


def _above(edges: DataFrame, ancestors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(edges, above): for every parent its (parent, ancestor, depth), itself at depth 1.

    Only inner nodes go through the rounds. A round joins the pairs found so far with themselves, so the
    length of the paths doubles; the rounds end when one finds nothing new, which it must, as pairs are
    finite. The result is written: Spark then knows how small it is beside the edges.
    """
    edges = materialise(edges, "edges")
    inner = _inner_edges(edges)
    found = inner.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    found, known, rounds = materialise(found, "closure-round"), None, 0
    while True:
        size = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("depth"), F.lit(0))).first()
        if size == known:
            break
        known, rounds = size, rounds + 1
        on = found.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("top"), F.col("depth").alias("more"))
        longer = found.join(on, "ancestor").where(F.col("child") != F.col("top"))
        longer = longer.select("child", F.col("top").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
        reached = found.unionByName(longer).groupBy("child", "ancestor").agg(F.min("depth").alias("depth"))
        found = materialise(reached, f"closure-round-{rounds}")
    itself = edges.select("parent", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")).distinct()
    above = itself.unionByName(
        found.select(F.col("child").alias("parent"), "ancestor", (F.col("depth") + 1).alias("depth"))
    )
    if ancestors is not None:
        above = above.join(ancestors.select("ancestor").distinct(), "ancestor", "left_semi")
    return edges, materialise(above, "above")


def closure(edges: DataFrame, ancestors: DataFrame | None = None) -> DataFrame:
    """All (child, ancestor, depth) pairs with the smallest depth; cycles are harmless.

    Inner nodes are closed in rounds, see :func:`_above`. Leaves, usually nearly all nodes, take one join
    with the result, and those with one parent need no regrouping: their depths are the smallest already.
    With ``ancestors`` only pairs below those concepts are unfolded to the leaves.
    """
    edges, above = _above(edges, ancestors)
    single = _leaf_parents(edges)
    plain = single.join(above, "parent").select("child", "ancestor", "depth")
    others = edges.join(single, "child", "left_anti").join(above, "parent").where(F.col("child") != F.col("ancestor"))
    return plain.unionByName(others.groupBy("child", "ancestor").agg(F.min("depth").alias("depth")))


def is_subclass_of(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Answer (child, ancestor) questions; every concept is a kind of itself."""
    pairs = materialise(pairs, "questions")
    known = closure(edges, pairs).select("child", "ancestor", F.lit(True).alias("__yes"))
    answered = pairs.join(known, ["child", "ancestor"], "left")
    yes = F.coalesce("__yes", F.col("child") == F.col("ancestor"))
    return answered.select("child", "ancestor", yes.alias("is_subclass"))


def roots_and_leaves(triples: DataFrame, kind: str = t.OWL_CLASS) -> DataFrame:
    """Concepts at the top or the bottom of the hierarchy, flagged; one pass over the triples."""
    typed = (F.col("p") == t.RDF_TYPE) & (F.col("o") == kind)
    edge = (F.col("p") == t.SUBCLASS_OF) & (F.col("s") != F.col("o"))
    child = F.struct(F.col("s").alias("concept"), typed.alias("typed"), edge.alias("up"), F.lit(False).alias("down"))
    parent = F.struct(
        F.col("o").alias("concept"), F.lit(False).alias("typed"), F.lit(False).alias("up"), edge.alias("down")
    )
    marks = triples.where(F.col("p").isin(t.RDF_TYPE, t.SUBCLASS_OF)).select(F.inline(F.array(child, parent)))
    seen = marks.groupBy("concept").agg(*[F.max(m).alias(m) for m in ("typed", "up", "down")])
    ends = seen.where(F.col("typed") & ~(F.col("up") & F.col("down")))
    return ends.select("concept", (~F.col("up")).alias("is_root"), (~F.col("down")).alias("is_leaf"))


def paths_from_root(edges: DataFrame, separator: str = " > ") -> DataFrame:
    """Shortest path from a root down to each concept; ties take the smallest text.

    Inner nodes are reached level by level; the leaves join once at the end. Nodes that only
    a cycle leads to have no root and so no path.
    """
    edges = materialise(edges, "edges")
    inner = _inner_edges(edges)
    children = edges.select(F.col("child").alias("concept"))
    tops = edges.select(F.col("parent").alias("concept")).distinct().join(children, "concept", "left_anti")
    roots = materialise(tops.select("concept", F.col("concept").alias("path"), F.lit(0).alias("depth")), "path-0")
    frontier, found, depth = roots, roots, 0
    while True:
        depth += 1
        fresh = _extend(frontier, inner, separator).join(found, "concept", "left_anti")
        frontier = materialise(fresh, f"path-{depth}")
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return roots.unionByName(_extend(found, edges, separator))


def _extend(reached: DataFrame, edges: DataFrame, separator: str) -> DataFrame:
    """The best way to each child of the concepts reached."""
    step = reached.select(F.col("concept").alias("parent"), "path", "depth").join(edges, "parent")
    way = F.struct((F.col("depth") + 1).alias("depth"), F.concat("path", F.lit(separator), "child").alias("path"))
    best = step.groupBy(F.col("child").alias("concept")).agg(F.min(way).alias("way"))
    return best.select("concept", "way.path", "way.depth")


def roll_up(
    values: DataFrame, edges: DataFrame, concept: str, value: str, out: str, scale: int | None = None
) -> DataFrame:
    """Each concept's own value plus those of all its descendants, each counted once.

    Values are summed per concept before they meet the hierarchy, so a concept with very many
    facts is one row by then. A leaf with one parent is then added to the parent's own sum; only
    inner nodes and leaves with several parents meet the closure. With a ``scale``, values are doubles
    of that many decimals and are summed without loss.
    """
    how = aggregate("sum", scale)
    edges, above = _above(edges)
    own = values.groupBy(F.col(concept).alias("child")).agg(*how.partial(F.col(value), "own"))
    own = materialise(own, "own-values")
    kinds = _leaf_parents(edges)
    placed = own.join(kinds, "child", "left")
    states = [F.col(f"own__{s}") for s in how.states]
    single = placed.where(F.col("parent").isNotNull()).select(F.col("parent").alias("child"), *states)
    others = placed.where(F.col("parent").isNull()).select("child", *states)
    base = materialise(others.unionByName(single).groupBy("child").agg(*how.merge("own")), "inner-values")
    several = edges.join(kinds, "child", "left_anti").select("child", "parent")
    lifted = several.join(above, "parent").where(F.col("child") != F.col("ancestor")).select("child", "ancestor").distinct()
    lifted = base.join(lifted, "child").select(F.col("ancestor").alias("concept"), *states)
    leaves = placed.where(F.col("parent").isNotNull()).select(F.col("child").alias("concept"), *states)
    everything = base.select(F.col("child").alias("concept"), *states).unionByName(lifted).unionByName(leaves)
    return everything.groupBy("concept").agg(*how.merge("own")).select("concept", _plain(how).alias(out))


def _plain(how: Aggregate) -> Column:
    total = how.result({s: F.col(f"own__{s}") for s in how.states})
    if not how.exact:
        return total
    odd = F.col("own__odd")
    return F.when(odd.isNotNull(), F.coalesce(total.cast("double"), F.lit(0.0)) + odd).otherwise(total.cast("double"))


def names(triples: DataFrame) -> DataFrame:
    """Case-folded labels and alternative labels with their concepts."""
    named = triples.where(F.col("p").isin(t.LABEL, t.ALT_LABEL))
    return named.select(F.lower(F.trim("o")).alias("name"), F.col("s").alias("concept"))


def resolve(terms: DataFrame, column: str, triples: DataFrame) -> DataFrame:
    """Distinct terms with the concepts they name; terms that name nothing keep a null.

    Matches and misses are taken apart. An inner join may be split on either side, so a name
    that very many concepts share does not end up in one task. Both sides are written once, since
    each is read twice.
    """
    asked = terms.select(F.col(column).alias("term")).distinct().withColumn("name", F.lower(F.trim("term")))
    asked, known = materialise(asked, "terms"), materialise(names(triples), "names")
    matched = asked.join(known, "name").select("term", "concept").distinct()
    missed = asked.join(known.select("name").distinct(), "name", "left_anti")
    return matched.unionByName(missed.select("term", F.lit(None).cast("string").alias("concept")))


def threshold_check(
    positions: DataFrame, keys: Sequence[str], columns: Sequence[str], triples: DataFrame, vocabulary: Vocabulary
) -> DataFrame:
    """Mapped columns of each row against the minimum their concept requires.

    The rules are written out first, so that Spark knows how few they are and does not shuffle
    the unfolded rows by the handful of column names.
    """
    properties = {"label": t.LABEL, "column_name": vocabulary.column, "minimum": vocabulary.minimum}
    rules = describe(triples, t.OWL_CLASS, properties).where(F.col("column_name").isin(*columns))
    rules = rules.select("column_name", "label", percent_text("minimum").alias("minimum_pct"))
    rules = materialise(rules.where(F.col("minimum_pct").isNotNull()), "threshold-rules")
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    unfolded = positions.select(*keys, F.inline(F.array(*pairs)))
    checked = unfolded.join(rules, "column_name")
    meets = F.col("value") >= F.col("minimum_pct")
    return checked.select(*keys, "column_name", "label", "value", "minimum_pct", meets.alias("meets_minimum"))
