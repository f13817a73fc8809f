"""Triples ``(s, p, o, lang, datatype)`` read from and written to N-Triples text.

A null ``datatype`` and ``lang`` mark an IRI object; a plain literal is an ``xsd:string``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "s string, p string, o string, lang string, datatype string"

# Public vocabulary terms of the W3C.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
SUBCLASS_OF = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
DEFINITION = "http://www.w3.org/2004/02/skos/core#definition"
ALT_LABEL = "http://www.w3.org/2004/02/skos/core#altLabel"
OWL_CLASS = "http://www.w3.org/2002/07/owl#Class"
OWL_INDIVIDUAL = "http://www.w3.org/2002/07/owl#NamedIndividual"
OWL_DATATYPE_PROPERTY = "http://www.w3.org/2002/07/owl#DatatypeProperty"
XSD_STRING = "http://www.w3.org/2001/XMLSchema#string"
XSD_DATE = "http://www.w3.org/2001/XMLSchema#date"

# A line is subject, predicate and object, spaced or not, and may end in a comment; an object is an IRI, a blank
# node or a literal. It is held against a line whose escapes are masked, so that a quote mark ends a literal.
_IRI, _BLANK = r"<[^>]*>", r"_:[^\s<>\"]*[^\s<>\".]"
_LITERAL = r"\"[^\"]*\"(?:@[A-Za-z0-9-]+|\^\^<[^>]*>)?"
_LINE = rf"^(\s*)({_IRI}|{_BLANK})(\s*)({_IRI})(\s*)({_IRI}|{_BLANK}|{_LITERAL})\s*\.\s*(?:#.*)?$"
_ESCAPE = r"\\U[0-9A-Fa-f]{8}|\\u[0-9A-Fa-f]{4}|\\."
_SUFFIX = r"\"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?$"

# The escapes of one letter.
_LETTERS = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def statement(p: str, o: Column, lang: str | None = None, datatype: str | None = None) -> Column:
    """A predicate and object as one struct, to be exploded beside its subject."""
    return F.struct(
        F.lit(p).alias("p"),
        o.cast("string").alias("o"),
        F.lit(lang).cast("string").alias("lang"),
        F.lit(LANG_STRING if lang else datatype).cast("string").alias("datatype"),
    )


def triples_of(df: DataFrame, subject: Column, *statements: Column) -> DataFrame:
    """Several triples per row in one pass; a null object makes no triple."""
    rows = df.select(subject.alias("s"), F.inline(F.array(*statements)))
    return rows.where(F.col("o").isNotNull())


def _statements(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the file, stripped, beside copies of the same length in which each escape is two letters."""
    lines = spark.read.text(path).select(F.btrim("value", F.lit(" \t")).alias("line"))
    masked = F.when(F.instr("line", "\\") > 0, F.regexp_replace("line", r"\\.", "xx")).otherwise(F.col("line"))
    return lines.select("line", masked.alias("masked"))


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither triples nor empty nor comments, which ``read_ntriples`` passes over."""
    known = F.col("masked").rlike(_LINE) | (F.col("line") == "") | F.col("line").startswith("#")
    return _statements(spark, path).where(~known).select("line")


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Parse N-Triples lines; see ``malformed`` for those that hold no triple."""
    lines = _statements(spark, path).where(F.col("masked").rlike(_LINE))
    sizes = [F.length(F.regexp_extract("masked", _LINE, k)).alias(f"n{k}") for k in range(1, 7)]
    lines = lines.select("line", *sizes)

    def part(k: int) -> Column:
        before = F.lit(1)
        for j in range(1, k):
            before = before + F.col(f"n{j}")
        return F.substring("line", before, F.col(f"n{k}"))

    fields = lines.select(_bare(part(2)).alias("s"), _bare(part(4)).alias("p"), part(6).alias("rest"))
    literal = F.col("rest").startswith('"')
    split = fields.select(
        "s",
        "p",
        F.when(~literal, _bare(F.col("rest"))).alias("iri"),
        F.when(literal, F.regexp_replace(F.expr("substring(rest, 2)"), _SUFFIX, "")).alias("text"),
        F.when(literal, F.nullif(F.regexp_extract("rest", _SUFFIX, 1), F.lit(""))).alias("lang"),
        F.when(literal, F.nullif(F.regexp_extract("rest", _SUFFIX, 2), F.lit(""))).alias("type"),
    )
    datatype = F.when(F.col("lang").isNotNull(), F.lit(LANG_STRING)).otherwise(F.coalesce("type", F.lit(XSD_STRING)))
    return split.select(
        "s",
        "p",
        F.coalesce("iri", _unescaped(F.col("text"))).alias("o"),
        "lang",
        F.when(F.col("text").isNotNull(), datatype).alias("datatype"),
    )


def _bare(node: Column) -> Column:
    """An IRI without its brackets and escapes; blank nodes stay as they are."""
    return F.when(node.startswith("_:"), node).otherwise(_unescaped(F.regexp_replace(node, r"^<|>$", "")))


def _unescaped(text: Column) -> Column:
    """Escapes read from left to right; one that is not known stays as it is."""

    def character(escape: Column) -> Column:
        hexed = F.lpad(F.substring(escape, F.lit(3), F.length(escape)), 8, "0")
        out = F.when(F.length(escape) > 2, F.decode(F.unhex(hexed), "UTF-32"))
        for letter, meant in _LETTERS.items():
            out = out.when(escape == f"\\{letter}", F.lit(meant))
        return out.otherwise(escape)

    pieces = F.zip_with(
        F.split(text, _ESCAPE), F.regexp_extract_all(text, F.lit(_ESCAPE), F.lit(0)),
        lambda piece, escape: F.concat(piece, F.when(escape.isNull(), "").otherwise(character(escape))),
    )
    return F.when(F.instr(text, "\\") > 0, F.array_join(pieces, "")).otherwise(text)


def _node(column: str) -> Column:
    return F.when(F.col(column).startswith("_:"), F.col(column)).otherwise(F.concat(F.lit("<"), column, F.lit(">")))


def write_ntriples(triples: DataFrame, path: str) -> None:
    quoted = F.expr("substring(boxed, 2, length(boxed) - 2)")
    literal = (
        F.when(F.col("lang").isNotNull(), F.concat(quoted, F.lit("@"), "lang"))
        .when(F.col("datatype") == XSD_STRING, quoted)
        .otherwise(F.concat(quoted, F.lit("^^<"), "datatype", F.lit(">")))
    )
    obj = F.when(F.col("datatype").isNull() & F.col("lang").isNull(), _node("o")).otherwise(literal)
    line = F.concat(_node("s"), F.lit(" <"), "p", F.lit("> "), obj, F.lit(" ."))
    boxed = triples.withColumn("boxed", F.to_json(F.array("o")))
    boxed.select(line.alias("value")).write.mode("overwrite").text(path)
