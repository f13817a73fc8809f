"""Mixing sources to target weights: hash-threshold histograms, DataFrame functions only.

Each source has a target in words. It is taken whole as many times as the target holds it, and the
documents whose hash lies below a threshold are taken once more. The threshold comes from a
histogram of words by source and hash prefix: the bucket in which the remaining budget ends is
refined by the next bits of the hash, until it holds a single hash. Nothing is sorted by hash, and a
larger budget always takes a superset of what a smaller one takes.

The source ends at whichever side of the last hash is nearer to the target. Documents are taken whole.
Null texts have size 0, null sources form a source of their own, ranked last. Rows that repeat an id
and a text have one hash; where the budget ends among them, as many are taken as come nearest to it, counted
off by file part, so that no task holds them all. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, text_of
from tessera.session import materialise

#: Weights of the sources in order of their code points, repeating.
WEIGHTS = (1, 2, 3)
#: No source is taken more often than this.
MAX_EPOCHS = 3
#: Bits of a document's hash, and how many of them one histogram tells apart for each source.
HASH_BITS = 60
LEVEL_BITS = 12


def size_of(text_column: str) -> Column:
    return F.regexp_count(text_of(text_column), F.lit(WORD)).cast("long")


def hash_of(id_column: str, text_column: str) -> Column:
    """60 bits of the MD5 of id and text."""
    key = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), text_of(text_column))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) for rows (source, size).

    All words are shared by weight. A source whose share exceeds its cap gets the cap, and what is
    over goes to the others by weight, again until no share exceeds its cap. Each round is one
    aggregate over the sources; a source once at its cap stays there.
    """
    # The rank takes one task: one row per source.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    sources = materialise(sources.withColumn("cap", F.col("source_size") * max_epochs), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, at_cap = 0.0, None
    while True:
        capped = F.lit(False) if at_cap is None else F.col("weight") * F.lit(level) > F.col("cap")
        n, taken, free = sources.agg(
            F.count(F.when(capped, 1)),
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)),
            F.sum(F.when(~capped, F.col("weight"))),
        ).first()
        if n == at_cap or not free:
            break
        level, at_cap = float(total - taken) / free, n
    target = F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def _thresholds(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, below, tied, extra): hashes under ``below`` are taken once more,
    and of the rows that share the hash ``tied``, if it is not null, ``extra`` rows.
    """
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    open_ones = shares.withColumn("epochs", epochs.cast("long")).select(
        "*",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
    )
    open_ones, bits, found = materialise(open_ones, "budgets"), 0, None
    while True:
        # Only the boundary bucket of each source is looked into.
        shift = HASH_BITS - bits - LEVEL_BITS
        edge = open_ones.select(F.col("source").alias("s"), F.col("prefix").alias("p"))
        inside = rows.join(
            edge, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", HASH_BITS - bits) == F.col("p"))
        )
        histogram = inside.groupBy("s", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        # At most 2^LEVEL_BITS rows for each source.
        running = Window.partitionBy("s").orderBy("bucket")
        histogram = histogram.withColumn("upto", F.sum("words").over(running))
        met = open_ones.join(histogram, F.col("source").eqNullSafe(F.col("s")) & (F.col("upto") > F.col("budget")), "left")
        first = met.groupBy("source", "source_size", "target", "epochs", "budget").agg(
            F.min_by(F.struct("bucket", "words", "upto", "docs", "low", "high"), "bucket").alias("b")
        )
        before = F.col("b.upto") - F.col("b.words")
        # Rows of one hash have one size. Of a single row this is whether its end is nearer than its start.
        extra = F.ceil((F.col("budget") - before) * F.col("b.docs") / F.col("b.words") - 0.5)
        split = (F.col("b.low") == F.col("b.high")) & (extra > 0) & (extra < F.col("b.docs"))
        step = materialise(
            first.select(
                "source", "source_size", "target", "epochs",
                (F.col("budget") - before).alias("budget"),
                F.col("b.bucket").alias("prefix"),
                F.coalesce(F.col("b.low") == F.col("b.high"), F.lit(True)).alias("closed"),
                # No bucket passes the budget: the source is taken whole once more.
                F.when(F.col("b").isNull(), F.lit(1 << HASH_BITS))
                .otherwise(F.when(extra >= F.col("b.docs"), F.col("b.low") + 1).otherwise(F.col("b.low"))).alias("below"),
                F.when(split, F.col("b.low")).alias("tied"),
                F.when(split, extra).cast("long").alias("extra"),
            ),
            "thresholds",
        )
        done = step.filter("closed").drop("closed", "budget", "prefix")
        found = done if found is None else found.union(done)
        open_ones, bits = step.filter("not closed").drop("closed", "below", "tied", "extra"), bits + LEVEL_BITS
        if bits >= HASH_BITS or open_ones.isEmpty():
            return found


def _counted(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` (with source and h) beside the limits of their sources, and ``copies``, how often each is taken."""
    met = rows.join(limits.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    once = F.when(F.col("h") < F.col("below"), 1).otherwise(0)
    if limits.filter("tied is not null").isEmpty():
        return met.withColumn("copies", F.col("epochs") + once)
    at_edge = F.coalesce(F.col("h") == F.col("tied"), F.lit(False))
    tied = met.filter(at_edge).withColumn("place", F.monotonically_increasing_id())
    # Written, so that a row keeps its place. The upper bits tell the part, the lower ones order the rows in it.
    tied = materialise(tied, "ties").withColumn("part", F.shiftright("place", 33))
    parts = tied.groupBy(F.col("source").alias("s"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    tied = tied.withColumn("rank", F.row_number().over(Window.partitionBy("source", "part").orderBy("place")))
    tied = tied.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    more = F.when(F.col("earlier") + F.col("rank") <= F.col("extra"), 1).otherwise(0)
    tied = tied.withColumn("copies", F.col("epochs") + more).drop("place", "part", "s", "p", "rank", "earlier")
    return met.filter(~at_edge).withColumn("copies", F.col("epochs") + once).unionByName(tied)


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """One row per document: (id, h, source, size, source_size, target, copies)."""
    rows = materialise(
        docs.select(
            F.col(id_column).alias("id"), F.col(source_column).alias("source"), size_of(text_column).alias("size"),
            hash_of(id_column, text_column).alias("h"),
        ),
        "sizes",
    )
    limits = materialise(_thresholds(rows, targets(rows, weights, max_epochs)), "limits")
    return _counted(rows, limits).select("id", "h", "source", "size", "source_size", "target", "copies")


def take(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """The mix itself: each document as many times as it is taken, all its columns as they came."""
    limits = docs.select(
        F.col(source_column).alias("source"), size_of(text_column).alias("size"), hash_of(id_column, text_column).alias("h")
    )
    limits = materialise(limits, "sizes")
    limits = materialise(_thresholds(limits, targets(limits, weights, max_epochs)), "limits")
    whole = docs.select(
        F.struct("*").alias("row"), F.col(source_column).alias("source"), hash_of(id_column, text_column).alias("h")
    )
    taken = _counted(whole, limits.drop("source_size", "target")).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
