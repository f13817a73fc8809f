"""Concepts derived from the party tables: customers below nations below regions.

Labels, definitions, aliases and requirements come from the same rows; the concepts that
describe measured columns are declared beside them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import ontology as onto
from tessera.plans.tables import CAPITAL_SQL, capital_position, read_table
from tessera.session import new_path
from tessera.sources import triples as t

BASE = "urn:concept:"
VOCABULARY = onto.Vocabulary("urn:vocabulary:")
ROOT = BASE + "all"
V = VOCABULARY

# Concepts of the measured columns (name, label, column or None, minimum or None).
COLUMN_CONCEPTS = (
    ("capital", "Capital", "cet1_capital_mm", None),
    ("assets", "Risk-Weighted Assets", "rwa_mm", None),
    ("ratio", "Capital Ratio", "cet1_ratio_pct", "30.5%"),
    ("buffer", "Combined Buffer", "combined_buffer", "2.5%"),
    ("headroom", "Headroom", None, None),
)


def _iri(kind: str, key: str):
    return F.concat(F.lit(f"{BASE}{kind}/"), F.col(key).cast("string"))


def _say(p: str, o, lang: str | None = None, datatype: str | None = None):
    return t.statement(p, o, lang, datatype)


def party_triples(spark: SparkSession, sf: str) -> DataFrame:
    customer = t.triples_of(
        read_table(spark, sf, "customer"),
        _iri("customer", "c_custkey"),
        _say(t.RDF_TYPE, F.lit(t.OWL_CLASS)),
        _say(t.SUBCLASS_OF, _iri("nation", "c_nationkey")),
        _say(t.LABEL, F.col("c_name"), lang="en"),
        _say(t.DEFINITION, F.concat(F.lit('A "'), "c_mktsegment", F.lit('" party')), lang="en"),
    )
    nation = t.triples_of(
        read_table(spark, sf, "nation"),
        _iri("nation", "n_nationkey"),
        _say(t.RDF_TYPE, F.lit(t.OWL_CLASS)),
        _say(t.SUBCLASS_OF, _iri("region", "n_regionkey")),
        _say(t.LABEL, F.col("n_name"), lang="en"),
        _say(t.ALT_LABEL, F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), lang="en"),
        _say(V.governed_by, _iri("regulation", "n_regionkey")),
        _say(V.minimum, F.concat(F.col("n_regionkey").cast("string"), F.lit(".5%")), datatype=t.XSD_STRING),
        _say(V.article, F.concat(F.lit("Article "), F.col("n_nationkey").cast("string")), datatype=t.XSD_STRING),
    )
    region = t.triples_of(
        read_table(spark, sf, "region"),
        _iri("region", "r_regionkey"),
        _say(t.RDF_TYPE, F.lit(t.OWL_CLASS)),
        _say(t.SUBCLASS_OF, F.lit(ROOT)),
        _say(t.LABEL, F.col("r_name"), lang="en"),
    )
    regulation = t.triples_of(
        read_table(spark, sf, "region"),
        _iri("regulation", "r_regionkey"),
        _say(t.RDF_TYPE, F.lit(t.OWL_INDIVIDUAL)),
        _say(t.LABEL, F.concat(F.lit("Rules of "), "r_name"), lang="en"),
        _say(V.publisher, F.concat("r_name", F.lit(" Office")), datatype=t.XSD_STRING),
        _say(V.effective, F.concat((F.col("r_regionkey") + 2013).cast("string"), F.lit("-01-01")), datatype=t.XSD_DATE),
    )
    return reduce(DataFrame.unionByName, [customer, nation, region, regulation, declared_triples(spark)])


def declared_triples(spark: SparkSession) -> DataFrame:
    """The root, and the concepts of the measured columns."""
    rows = [(ROOT, t.RDF_TYPE, t.OWL_CLASS, None, None), (ROOT, t.LABEL, "All parties", "en", t.LANG_STRING)]
    for name, label, column, minimum in COLUMN_CONCEPTS:
        iri = f"{BASE}measure/{name}"
        rows += [(iri, t.RDF_TYPE, t.OWL_CLASS, None, None), (iri, t.LABEL, label, "en", t.LANG_STRING)]
        rows += [(iri, V.column, column, None, t.XSD_STRING)] if column else []
        rows += [(iri, V.minimum, minimum, None, t.XSD_STRING)] if minimum else []
    return spark.createDataFrame(rows, t.SCHEMA).coalesce(1)


def _edges(spark, sf) -> DataFrame:
    return onto.subclass_edges(party_triples(spark, sf))


def triples_scan(spark, sf):
    """All triples, written as N-Triples text and read back."""
    path = new_path(spark, "ntriples")
    t.write_ntriples(party_triples(spark, sf), path)
    return t.read_ntriples(spark, path)


def triples_malformed(spark, sf):
    """Lines of a file that hold a triple, and lines that should but do not."""
    said = F.concat(F.lit("<"), _iri("nation", "n_nationkey"), F.lit(f'><{t.LABEL}>"'), "n_name", F.lit('"@en.'))
    broken = F.concat(F.lit("<"), _iri("supplier", "s_suppkey"), F.lit("> says "), "s_name")
    lines = read_table(spark, sf, "nation").select(said.alias("value"))
    lines = lines.unionByName(read_table(spark, sf, "supplier").select(broken.alias("value")))
    lines = lines.unionByName(read_table(spark, sf, "region").select(F.concat(F.lit("# "), "r_name").alias("value")))
    path = new_path(spark, "lines")
    lines.write.text(path)
    good = t.read_ntriples(spark, path).select(F.lit("triple").alias("line"))
    bad = t.malformed(spark, path).select(F.lit("malformed").alias("line"))
    return good.unionByName(bad).groupBy("line").agg(F.count(F.lit(1)).alias("lines"))


def concept_scan(spark, sf):
    return onto.subjects(party_triples(spark, sf), t.OWL_CLASS).withColumnRenamed("s", "concept")


def concept_table(spark, sf):
    return onto.concepts(party_triples(spark, sf), VOCABULARY)


def regulation_table(spark, sf):
    return onto.regulations(party_triples(spark, sf), VOCABULARY)


def concept_parent_label(spark, sf):
    return onto.linked_label(party_triples(spark, sf), t.SUBCLASS_OF, "parent_label")


def concept_regulation(spark, sf):
    return onto.linked_label(party_triples(spark, sf), V.governed_by, "regulation_label")


def _position_columns(spark, sf) -> DataFrame:
    """The capital table's columns with the rows that fill them."""
    rows = capital_position(spark, sf)
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_rows")) for c in rows.columns]
    return filled.select(F.inline(F.array(*pairs)))


def column_concepts(spark, sf):
    return onto.column_concepts(_position_columns(spark, sf), party_triples(spark, sf), VOCABULARY)


def unmapped_columns(spark, sf):
    return onto.unmapped_columns(_position_columns(spark, sf), party_triples(spark, sf), VOCABULARY)


def subclass_closure(spark, sf):
    return onto.closure(_edges(spark, sf))


def is_subclass_of(spark, sf):
    """For every concept: is it a kind of the first region?"""
    asked = onto.subjects(party_triples(spark, sf), t.OWL_CLASS).select(
        F.col("s").alias("child"), F.lit(BASE + "region/0").alias("ancestor")
    )
    return onto.is_subclass_of(asked, _edges(spark, sf))


def concept_path(spark, sf):
    return onto.paths_from_root(_edges(spark, sf))


def concept_roots(spark, sf):
    return onto.roots_and_leaves(party_triples(spark, sf))


def hierarchy_rollup(spark, sf):
    amounts = read_table(spark, sf, "orders").select(
        _iri("customer", "o_custkey").alias("concept"), F.col("o_totalprice").alias("amount")
    )
    return onto.roll_up(amounts, _edges(spark, sf), "concept", "amount", "total", scale=2)


def resolve_alias(spark, sf):
    """Names as suppliers and customers write them, to concepts."""
    terms = (
        read_table(spark, sf, "supplier")
        .select(F.concat(F.lit(" n"), F.col("s_nationkey").cast("string")).alias("term"))
        .unionByName(read_table(spark, sf, "customer").select(F.upper("c_name").alias("term")))
        .unionByName(read_table(spark, sf, "customer").select(F.col("c_mktsegment").alias("term")))
    )
    return onto.resolve(terms, "term", party_triples(spark, sf))


def concept_threshold_check(spark, sf):
    columns = ["cet1_capital_mm", "rwa_mm", "cet1_ratio_pct", "combined_buffer"]
    return onto.threshold_check(
        capital_position(spark, sf), ["entity", "reporting_date"], columns, party_triples(spark, sf), VOCABULARY
    )


QUERIES = {
    "triples_scan": triples_scan,
    "triples_malformed": triples_malformed,
    "concept_scan": concept_scan,
    "concept_table": concept_table,
    "regulation_table": regulation_table,
    "concept_parent_label": concept_parent_label,
    "concept_regulation": concept_regulation,
    "column_concepts": column_concepts,
    "unmapped_columns": unmapped_columns,
    "subclass_closure": subclass_closure,
    "is_subclass_of": is_subclass_of,
    "concept_path": concept_path,
    "concept_roots": concept_roots,
    "hierarchy_rollup": hierarchy_rollup,
    "resolve_alias": resolve_alias,
    "concept_threshold_check": concept_threshold_check,
}


def _declared_sql() -> str:
    rows = [f"('{ROOT}', 'type', '{t.OWL_CLASS}')", f"('{ROOT}', 'label', 'All parties')"]
    for name, label, column, minimum in COLUMN_CONCEPTS:
        iri = f"{BASE}measure/{name}"
        rows += [f"('{iri}', 'type', '{t.OWL_CLASS}')", f"('{iri}', 'label', '{label}')"]
        rows += [f"('{iri}', 'column', '{column}')"] if column else []
        rows += [f"('{iri}', 'minimum', '{minimum}')"] if minimum else []
    return ", ".join(rows)


_SQL = f"""
WITH RECURSIVE triples(s, p, o) AS (
    SELECT '{BASE}customer/' || c_custkey, 'type', '{t.OWL_CLASS}' FROM customer
    UNION ALL SELECT '{BASE}customer/' || c_custkey, 'subclass', '{BASE}nation/' || c_nationkey FROM customer
    UNION ALL SELECT '{BASE}customer/' || c_custkey, 'label', c_name FROM customer
    UNION ALL SELECT '{BASE}customer/' || c_custkey, 'definition', 'A "' || c_mktsegment || '" party' FROM customer
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'type', '{t.OWL_CLASS}' FROM nation
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'subclass', '{BASE}region/' || n_regionkey FROM nation
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'label', n_name FROM nation
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'alt', 'N' || n_nationkey FROM nation
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'governed', '{BASE}regulation/' || n_regionkey FROM nation
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'minimum', n_regionkey || '.5%' FROM nation
    UNION ALL SELECT '{BASE}nation/' || n_nationkey, 'article', 'Article ' || n_nationkey FROM nation
    UNION ALL SELECT '{BASE}region/' || r_regionkey, 'type', '{t.OWL_CLASS}' FROM region
    UNION ALL SELECT '{BASE}region/' || r_regionkey, 'subclass', '{ROOT}' FROM region
    UNION ALL SELECT '{BASE}region/' || r_regionkey, 'label', r_name FROM region
    UNION ALL SELECT '{BASE}regulation/' || r_regionkey, 'type', '{t.OWL_INDIVIDUAL}' FROM region
    UNION ALL SELECT '{BASE}regulation/' || r_regionkey, 'label', 'Rules of ' || r_name FROM region
    UNION ALL SELECT '{BASE}regulation/' || r_regionkey, 'publisher', r_name || ' Office' FROM region
    UNION ALL SELECT '{BASE}regulation/' || r_regionkey, 'effective', (r_regionkey + 2013) || '-01-01' FROM region
    UNION ALL SELECT * FROM (VALUES {_declared_sql()})
),
concepts AS (SELECT DISTINCT s AS concept FROM triples WHERE p = 'type' AND o = '{t.OWL_CLASS}'),
labels AS (SELECT s AS concept, MIN(o) AS label FROM triples WHERE p = 'label' GROUP BY ALL),
edges AS (SELECT DISTINCT s AS child, o AS parent FROM triples WHERE p = 'subclass'),
walk(child, ancestor, depth, path) AS (
    SELECT child, parent, 1, parent || ' > ' || child FROM edges
    UNION ALL
    SELECT walk.child, edges.parent, walk.depth + 1, edges.parent || ' > ' || walk.path
    FROM walk JOIN edges ON walk.ancestor = edges.child
),
closure AS (SELECT child, ancestor, MIN(depth) AS depth FROM walk GROUP BY ALL)
"""

_PREDICATES = {
    "type": t.RDF_TYPE,
    "subclass": t.SUBCLASS_OF,
    "label": t.LABEL,
    "definition": t.DEFINITION,
    "alt": t.ALT_LABEL,
    "governed": V.governed_by,
    "minimum": V.minimum,
    "article": V.article,
    "publisher": V.publisher,
    "effective": V.effective,
    "column": V.column,
}


def _one(p: str, alias: str) -> str:
    return f"(SELECT MIN(o) FROM triples WHERE triples.s = concept AND p = '{p}') AS {alias}"


_FILLED = f"""{CAPITAL_SQL},
    filled AS (
        UNPIVOT (SELECT COUNT(reporting_date) AS reporting_date, COUNT(entity) AS entity,
                        COUNT(cet1_capital_mm) AS cet1_capital_mm, COUNT(rwa_mm) AS rwa_mm,
                        COUNT(cet1_ratio_pct) AS cet1_ratio_pct, COUNT(combined_buffer) AS combined_buffer
                 FROM capital_position)
        ON COLUMNS(*) INTO NAME column_name VALUE filled_rows)"""

ORACLE = {
    "triples_scan": f"""{_SQL}
        SELECT s, CASE p {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PREDICATES.items())} END AS p, o,
               CASE WHEN p IN ('label', 'definition', 'alt') THEN 'en' END AS lang,
               CASE WHEN p IN ('label', 'definition', 'alt') THEN '{t.LANG_STRING}'
                    WHEN p = 'effective' THEN '{t.XSD_DATE}'
                    WHEN p IN ('minimum', 'article', 'publisher', 'column') THEN '{t.XSD_STRING}' END AS datatype
        FROM triples""",
    "concept_scan": f"{_SQL} SELECT concept FROM concepts",
    "concept_table": f"""{_SQL}
        SELECT concept, MIN(o) FILTER (p = 'label') AS label, MIN(o) FILTER (p = 'alt') AS alt_label,
               MIN(o) FILTER (p = 'definition') AS definition, MIN(o) FILTER (p = 'subclass') AS parent,
               CAST(NULL AS VARCHAR) AS formula, MIN(o) FILTER (p = 'minimum') AS minimum,
               MIN(o) FILTER (p = 'article') AS article, MIN(o) FILTER (p = 'governed') AS governed_by,
               MIN(o) FILTER (p = 'column') AS column_name, CAST(NULL AS VARCHAR) AS unit,
               CAST(NULL AS VARCHAR) AS fixed_rate
        FROM concepts JOIN triples ON s = concept GROUP BY concept""",
    "regulation_table": f"""{_SQL}
        SELECT s AS regulation, MIN(o) FILTER (p = 'label') AS label, CAST(NULL AS VARCHAR) AS definition,
               MIN(o) FILTER (p = 'publisher') AS publisher, CAST(MIN(o) FILTER (p = 'effective') AS DATE) AS effective
        FROM triples GROUP BY s HAVING COUNT(*) FILTER (p = 'type' AND o = '{t.OWL_INDIVIDUAL}') > 0""",
    "concept_parent_label": f"""{_SQL}
        SELECT concepts.concept, own.label, up.label AS parent_label
        FROM concepts JOIN labels own USING (concept)
        LEFT JOIN edges ON child = concepts.concept LEFT JOIN labels up ON up.concept = parent""",
    "concept_regulation": f"""{_SQL}
        SELECT concepts.concept, own.label, rule.label AS regulation_label
        FROM concepts JOIN labels own USING (concept)
        LEFT JOIN triples ON s = concepts.concept AND p = 'governed' LEFT JOIN labels rule ON rule.concept = o""",
    "column_concepts": f"""{_FILLED}
        SELECT column_name, filled_rows, concept, label FROM filled JOIN (VALUES
            ('cet1_capital_mm', '{BASE}measure/capital', 'Capital'), ('rwa_mm', '{BASE}measure/assets', 'Risk-Weighted Assets'),
            ('cet1_ratio_pct', '{BASE}measure/ratio', 'Capital Ratio'),
            ('combined_buffer', '{BASE}measure/buffer', 'Combined Buffer')) AS m(column_name, concept, label)
        USING (column_name)""",
    "unmapped_columns": f"""{_FILLED}
        SELECT * FROM filled WHERE column_name NOT IN
            ('cet1_capital_mm', 'rwa_mm', 'cet1_ratio_pct', 'combined_buffer')""",
    "subclass_closure": f"{_SQL} SELECT * FROM closure",
    "is_subclass_of": f"""{_SQL}
        SELECT concept AS child, '{BASE}region/0' AS ancestor,
               concept = '{BASE}region/0' OR concept IN (SELECT child FROM closure WHERE ancestor = '{BASE}region/0')
                   AS is_subclass
        FROM concepts""",
    "concept_path": f"""{_SQL}
        SELECT child AS concept, path, depth FROM walk WHERE ancestor NOT IN (SELECT child FROM edges)
        UNION ALL SELECT DISTINCT parent, parent, 0 FROM edges WHERE parent NOT IN (SELECT child FROM edges)""",
    "concept_roots": f"""{_SQL}
        SELECT * FROM (
            SELECT concept, concept NOT IN (SELECT child FROM edges) AS is_root,
                   concept NOT IN (SELECT parent FROM edges) AS is_leaf
            FROM concepts)
        WHERE is_root OR is_leaf""",
    "hierarchy_rollup": f"""{_SQL},
        own AS (
            SELECT '{BASE}customer/' || o_custkey AS concept, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v
            FROM orders GROUP BY ALL)
        SELECT concept, CAST(SUM(v) AS DOUBLE) AS total
        FROM (SELECT concept, v FROM own UNION ALL SELECT ancestor, v FROM own JOIN closure ON child = concept)
        GROUP BY ALL""",
    "resolve_alias": f"""{_SQL},
        terms AS (
            SELECT DISTINCT ' n' || s_nationkey AS term FROM supplier
            UNION SELECT UPPER(c_name) FROM customer UNION SELECT c_mktsegment FROM customer),
        names AS (SELECT DISTINCT LOWER(TRIM(o)) AS name, s AS concept FROM triples WHERE p IN ('label', 'alt'))
        SELECT term, concept FROM terms LEFT JOIN names ON LOWER(TRIM(term)) = name""",
    "concept_threshold_check": f"""{CAPITAL_SQL}
        SELECT entity, reporting_date, 'cet1_ratio_pct' AS column_name, 'Capital Ratio' AS label,
               cet1_ratio_pct AS value, CAST(30.5 AS DOUBLE) AS minimum_pct, cet1_ratio_pct >= 30.5 AS meets_minimum
        FROM capital_position
        UNION ALL
        SELECT entity, reporting_date, 'combined_buffer', 'Combined Buffer', combined_buffer, 2.5,
               combined_buffer >= 2.5
        FROM capital_position""",
    "triples_malformed": """
        SELECT 'triple' AS line, COUNT(*) AS lines FROM nation UNION ALL SELECT 'malformed', COUNT(*) FROM supplier""",
}
