"""Data contracts in three dialects, read into one shape and offered as catalogue tables.

The dialects are a short hand-written contract, the open data contract standard, and the open
data product standard. Contract documents are small configuration files.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = "not specified"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    description: str = MISSING
    required: bool = False


@dataclass(frozen=True)
class Promise:
    """A service level: its kind, the promised value, and the column it is read from."""

    kind: str
    value: str
    description: str = MISSING
    column: str | None = None


@dataclass(frozen=True)
class Contract:
    id: str
    title: str
    dialect: str
    version: str
    status: str
    owner: str
    contact: str
    usage: str
    limitations: str
    tables: dict[str, tuple[ColumnSpec, ...]]
    table_descriptions: dict[str, str]
    checks: dict[str, tuple[str, ...]]
    promises: tuple[Promise, ...]
    lineage: tuple[str, ...]
    tags: tuple[str, ...]
    terms: dict[str, str]

    def columns(self, table: str) -> tuple[ColumnSpec, ...]:
        return self.tables[table]

    def promise(self, kind: str) -> Promise | None:
        return next((p for p in self.promises if p.kind == kind), None)


def load(path: str | Path) -> Contract:
    """Read a contract from a JSON file, or from YAML where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix == ".json":
        return read(json.loads(text))
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("YAML contracts need a YAML reader; JSON contracts do not") from error
    return read(yaml.safe_load(text))


def read(document: Mapping) -> Contract:
    if "dataContractSpecification" in document:
        return _read_table_standard(document)
    if "openDataProductSpecification" in document:
        return _read_product_standard(document)
    if "tables" in document:
        return _read_short_form(document)
    raise ValueError("not a contract in a known dialect")


def _text(node: Mapping, key: str) -> str:
    value = node.get(key)
    return " ".join(str(value).split()) if value not in (None, "") else MISSING


def _terms(node: Mapping) -> dict[str, str]:
    return {k: _text(node, k) for k in node}


def _column(name: str, node: Mapping) -> ColumnSpec:
    return ColumnSpec(name, _text(node, "type"), _text(node, "description"), bool(node.get("required", False)))


def _read_short_form(doc: Mapping) -> Contract:
    tables = {t["name"]: tuple(_column(c["name"], c) for c in t.get("columns", [])) for t in doc["tables"]}
    lineage = doc.get("lineage", {})
    sources = [s["name"] for s in lineage.get("source_systems", [])] + list(lineage.get("source_scripts", []))
    cadence = lineage.get("refresh_cadence")
    return Contract(
        id=_text(doc, "name"),
        title=_text(doc, "name"),
        dialect="short form",
        version=_text(doc, "version"),
        status=MISSING,
        owner=_text(doc, "owner"),
        contact=_text(doc, "owner"),
        usage=MISSING,
        limitations=MISSING,
        tables=tables,
        table_descriptions={t["name"]: _text(t, "description") for t in doc["tables"]},
        checks={},
        promises=(Promise("refresh", str(cadence)),) if cadence else (),
        lineage=tuple(sources),
        tags=(),
        terms={},
    )


def _read_table_standard(doc: Mapping) -> Contract:
    info, terms = doc.get("info", {}), doc.get("terms", {})
    contact = info.get("contact", {})
    checks: dict[str, tuple[str, ...]] = {}
    for heading, listed in (doc.get("quality", {}).get("specification") or {}).items():
        table = heading.removeprefix("checks for ").strip()
        checks[table] = (*checks.get(table, ()), *(str(c) for c in listed))
    promises = []
    for kind, node in (doc.get("servicelevels") or {}).items():
        keys = ("threshold", "period", "percentage", "responseTime", "recovery", "interval")
        value = next((str(node[k]) for k in keys if node.get(k) is not None), MISSING)
        column = str(node["timestampField"]).split(".")[-1] if node.get("timestampField") else None
        promises.append(Promise(kind, value, _text(node, "description"), column))
    models = doc.get("models", {})
    return Contract(
        id=_text(doc, "id"),
        title=_text(info, "title"),
        dialect="data contract",
        version=_text(info, "version"),
        status=_text(info, "status"),
        owner=_text(info, "owner"),
        contact=_text(contact, "email"),
        usage=_text(terms, "usage"),
        limitations=_text(terms, "limitations"),
        tables={t: tuple(_column(n, c) for n, c in m.get("fields", {}).items()) for t, m in models.items()},
        table_descriptions={t: _text(m, "description") for t, m in models.items()},
        checks=checks,
        promises=tuple(promises),
        lineage=tuple(f"{s.get('type', '')}:{s.get('path', n)}" for n, s in doc.get("servers", {}).items()),
        tags=tuple(info.get("tags", [])),
        terms=_terms(terms),
    )


def _read_product_standard(doc: Mapping) -> Contract:
    product = doc["product"]
    owner, terms = product.get("owner", {}), product.get("terms", {})
    listed = [t for port in product.get("outputPorts", []) for t in port.get("tables", [])]
    rules = tuple(str(c) for group in product.get("dataQuality", []) for c in group.get("checks", []))
    promises = [
        Promise(s["dimension"], str(s["value"]), _text(s, "description"), s.get("column"))
        for s in product.get("slaProperties", [])
    ]
    if terms.get("dataRetention"):
        promises.append(Promise("retention", str(terms["dataRetention"])))
    return Contract(
        id=_text(product, "productID"),
        title=_text(product, "name"),
        dialect="data product",
        version=_text(product, "version"),
        status=_text(product, "status"),
        owner=_text(owner, "name"),
        contact=_text(owner, "email"),
        usage=_text(terms, "usage"),
        limitations=_text(terms, "limitations"),
        tables={t["name"]: tuple(_column(c["name"], c) for c in t.get("columns", [])) for t in listed},
        table_descriptions={t["name"]: _text(t, "description") for t in listed},
        checks={t["name"]: rules for t in listed},
        promises=tuple(promises),
        lineage=tuple(p["name"] for p in product.get("inputPorts", [])),
        tags=tuple(product.get("tags", [])),
        terms=_terms(terms) | {"useCases": "; ".join(product.get("useCases", [])) or MISSING},
    )


def contract_table(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    rows = [
        (c.id, c.title, c.dialect, c.version, c.status, c.owner, c.contact, c.usage, c.limitations, list(c.lineage))
        for c in contracts
    ]
    return spark.createDataFrame(
        rows,
        "contract string, title string, dialect string, version string, status string, owner string, "
        "contact string, usage string, limitations string, lineage array<string>",
    )


def column_table(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    rows = [
        (c.id, table, position, col.name, col.type, col.required, col.description)
        for c in contracts
        for table, cols in c.tables.items()
        for position, col in enumerate(cols, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "contract string, table_name string, position int, column_name string, declared_type string, "
        "required boolean, description string",
    )


def check_table(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    rows = [(c.id, table, rule) for c in contracts for table, rules in c.checks.items() for rule in rules]
    return spark.createDataFrame(rows, "contract string, table_name string, check_text string")


def promise_table(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    rows = [(c.id, p.kind, p.value, p.column, p.description) for c in contracts for p in c.promises]
    return spark.createDataFrame(
        rows, "contract string, kind string, value string, column_name string, description string"
    )


def governance_facts(contract: Contract) -> list[tuple[str, str]]:
    """Who owns the data, how to reach them, and what is promised and allowed."""
    facts = [
        ("title", contract.title),
        ("version", contract.version),
        ("status", contract.status),
        ("owner", contract.owner),
        ("contact", contract.contact),
        ("usage", contract.usage),
        ("limitations", contract.limitations),
        ("lineage", ", ".join(contract.lineage) or MISSING),
        ("tags", ", ".join(contract.tags) or MISSING),
    ]
    facts += [(f"service level {p.kind}", f"{p.value}: {p.description}") for p in contract.promises]
    return facts + [(f"term {k}", v) for k, v in contract.terms.items()]


def governance_lookup(df: DataFrame, contract: Contract, table: str, updated: str | None = None) -> DataFrame:
    """The contract's facts about a table beside the state it is in: rows and newest entry."""
    newest = F.max(updated).cast("string") if updated else F.lit(None).cast("string")
    state = df.agg(F.count(F.lit(1)).alias("table_rows"), newest.alias("newest"))
    facts = [F.struct(F.lit(k).alias("field"), F.lit(v).alias("value")) for k, v in governance_facts(contract)]
    return state.select(F.lit(table).alias("table_name"), "table_rows", "newest", F.inline(F.array(*facts)))


# Declared type names of the contract dialects and the Spark types that satisfy them.
TYPE_FAMILIES = {
    "DATE": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
    "VARCHAR": (T.StringType,),
    "STRING": (T.StringType,),
    "TEXT": (T.StringType,),
    "NUMBER": (T.NumericType,),
    "NUMERIC": (T.NumericType,),
    "DECIMAL": (T.DecimalType, T.DoubleType),
    "DOUBLE": (T.DoubleType, T.FloatType),
    "INTEGER": (T.IntegerType, T.LongType, T.ShortType),
    "LONG": (T.LongType,),
    "BIGINT": (T.LongType,),
    "BOOLEAN": (T.BooleanType,),
}


def type_matches(declared: str, actual: T.DataType) -> bool:
    """Whether a column's type serves the declared one; unknown names never do."""
    family = TYPE_FAMILIES.get(declared.split("(")[0].strip().upper(), ())
    return isinstance(actual, family)
