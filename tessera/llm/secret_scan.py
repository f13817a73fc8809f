"""Secrets in texts, told from copied examples by who else holds them. DataFrame functions only.

Three patterns give the base spans: assigned passwords and tokens, access keys, long hexadecimal runs. What else
looks like a credential, a long run of letters and digits with many different characters outside the base spans,
is a candidate. All of them, base and candidate, are counted over the corpus by the SHA-256 of the value: how
many repositories and how many owners hold it. A value that one owner holds in few repositories is taken for
live; one that many hold is a copied example. Base spans always stay; candidates are added where they are live.

Positions are code points. Matches of a pattern are found from left to right and do not overlap; the text is split at
them, and where each begins is a running sum of lengths, taken in blocks so that a text with very many matches
costs little more than its length. Only digests and positions leave the reading of the texts.

Counts are added up by value, owner and repository first, then by value and owner, then by value: a value that
sits in a third of all rows is spread over its repositories, and meets its counts by a broadcast of at most ``HOT``
rows. A repository belongs to its owner. A null text is empty; a null owner or repository counts as one of its own;
repeated rows are scanned alike and are one repository; ties cannot occur, as a kind has one span at a position.
Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.session import materialise

# The base patterns, and the fewest characters of a value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

#: Kinds of spans, in the order in which those that begin together are listed.
KINDS = ("assign", "access", "hex", "token")
#: A candidate: a whole run of at least so many of these characters, of which so many are different.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
DIFFERENT = 10
#: Lengths that one block of a running sum holds.
BLOCK = 256
#: A value is joined by broadcast if it has more than one in so many of all spans.
HOT = 4096


@dataclass(frozen=True)
class Limits:
    """The most owners and repositories that a live value may have."""

    owners: int = 1
    repositories: int = 8


def running_sum(values: Column) -> Column:
    """Sums of the first 1, 2, ... entries of an array of integers."""
    whole = F.array().cast("array<int>")
    block = lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int") + (F.size(values) == 0).cast("int")), block)
    within = lambda part: F.aggregate(
        part, F.struct(F.lit(0).alias("s"), whole.alias("l")),
        lambda held, x: F.struct((held["s"] + x).alias("s"), F.concat(held["l"], F.array(held["s"] + x)).alias("l")),
    )
    return F.aggregate(
        F.transform(blocks, within), F.struct(F.lit(0).alias("s"), F.array().cast("array<array<int>>").alias("l")),
        lambda held, part: F.struct(
            (held["s"] + part["s"]).alias("s"), F.concat(held["l"], F.array(F.transform(part["l"], lambda x: x + held["s"]))).alias("l")
        ),
        lambda held: F.flatten(held["l"]),
    )


SPANS = "array<struct<start:int,kind:int,end:int,base:boolean,digest:binary,long:boolean,shaped:boolean>>"


def _split(df: DataFrame, text: str, pattern: str, name: str, value_group: int = 0, when: Column | None = None) -> DataFrame:
    """Columns ``name``_pieces, _found and _values: the text around the matches, the matches, and their values."""
    there = F.col(text).rlike(pattern) if when is None else when & F.col(text).rlike(pattern)
    df = df.withColumn(f"{name}_there", there)
    there = F.col(f"{name}_there")
    df = df.withColumn(f"{name}_pieces", F.when(there, F.split(text, pattern)))
    df = df.withColumn(f"{name}_found", F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    if value_group:
        return df.withColumn(f"{name}_values", F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))))
    return df.withColumn(f"{name}_values", F.col(f"{name}_found"))


def _spans(name: str, kind: int, base: bool, least: int) -> Column:
    """The spans of a kind whose value has ``least`` characters, as (start, kind, end, base, digest, shaped)."""
    pieces, found, values = (F.col(f"{name}_{c}") for c in ("pieces", "found", "values"))
    steps = F.transform(found, lambda m, i: F.length(pieces[i]) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0))
    starts = running_sum(steps)
    rows = F.transform(F.arrays_zip(starts.alias("a"), found.alias("b"), values.alias("c")), lambda x: F.struct(
        x["a"].alias("start"), F.lit(kind).alias("kind"), (x["a"] + F.length(x["b"])).alias("end"), F.lit(base).alias("base"),
        F.unhex(F.sha2(x["c"], 256)).alias("digest"), (F.length(x["c"]) >= least).alias("long"), looks_live(x["c"]).alias("shaped"),
    ))
    return F.coalesce(F.filter(rows, lambda s: s["long"]), F.array().cast(SPANS))


def looks_live(value: Column) -> Column:
    """Letters, digits and many different characters."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= DIFFERENT)


def _blanked(text: Column, name: str, least: int) -> Column:
    """The text with one space for each character of the matches that count."""
    blank = lambda m, v: F.when(F.length(v) >= least, F.repeat(F.lit(" "), F.length(m))).otherwise(m)
    marks = F.zip_with(F.col(f"{name}_found"), F.col(f"{name}_values"), blank)
    joined = F.array_join(F.zip_with(F.col(f"{name}_pieces"), marks, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    return F.when(F.col(f"{name}_there"), joined).otherwise(text)


def find(docs: DataFrame, id_column: str, text_column: str, repository_column: str, owner_column: str) -> DataFrame:
    """(row, id, repository, owner, spans): base spans and candidates of each text, without their values."""
    df = docs.select(
        F.col(id_column).alias("id"), F.col(repository_column).alias("repository"), F.col(owner_column).alias("owner"),
        text_of(text_column).alias("t"),
    )
    for name, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0)):
        df = _split(df, "t", pattern, name, group)
    # Candidates lie outside the base spans.
    df = df.withColumn("t", _blanked(F.col("t"), "assign", ASSIGN_VALUE))
    for name, pattern in (("access", ACCESS), ("hex", HEX)):
        df = _split(df, "t", pattern, f"rest_{name}", when=F.col(f"{name}_there"))
        df = df.withColumn("t", _blanked(F.col("t"), f"rest_{name}", 0))
    df = _split(df, "t", TOKEN, "token")
    spans = F.concat(
        _spans("assign", 0, True, ASSIGN_VALUE), _spans("access", 1, True, 0), _spans("hex", 2, True, 0),
        F.filter(_spans("token", 3, False, 0), lambda s: s["shaped"]),
    )
    return df.select(F.monotonically_increasing_id().alias("row"), "id", "repository", "owner", spans.alias("spans"))


def ownership(spans: DataFrame) -> DataFrame:
    """(digest, owners, repositories, spans) from rows (digest, owner, repository)."""
    each = spans.groupBy("digest", "owner", "repository").agg(F.count("*").alias("spans"))
    owners = each.groupBy("digest", "owner").agg(F.count("*").alias("repositories"), F.sum("spans").alias("spans"))
    return owners.groupBy("digest").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("spans").alias("spans")
    )


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository_column: str = "doc_id",
    owner_column: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """(id, spans) for each row; spans as (start, kind, end, base, owners, repositories, live), in order."""
    found = materialise(find(docs, id_column, text_column, repository_column, owner_column), "spans")
    single = materialise(
        found.select("row", "id", "repository", "owner", F.explode("spans").alias("s")).select("row", "id", "repository", "owner", "s.*").drop("long"),
        "single-spans",
    )
    held = materialise(ownership(single), "ownership")
    total = held.agg(F.sum("spans")).first()[0] or 0
    known = held.withColumnRenamed("spans", "n")
    hot = F.broadcast(known.filter(F.col("n") * HOT > total))
    rest = single.join(hot.select("digest"), "digest", "left_anti").join(known.filter(F.col("n") * HOT <= total), "digest")
    judged = single.join(hot, "digest").unionByName(rest)
    live = F.col("shaped") & (F.col("owners") <= limits.owners) & (F.col("repositories") <= limits.repositories)
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct(
        "start", F.col("kind").alias("order"), kind.alias("kind"), "end", "base", "owners", "repositories", live.alias("live")
    )
    # A row's spans, no more than its text holds.
    shown = judged.filter(F.col("base") | live).groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    rows = found.select("row", "id").join(shown, "row", "left")
    return rows.select("id", F.transform(F.coalesce("spans", F.array().cast(shown.schema["spans"].dataType)), lambda s: s.dropFields("order")).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")
