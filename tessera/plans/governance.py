"""Contracts over orders, items, events and labels: checks, service levels, conformance."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.plans import retail
from tessera.plans.tables import read_table
from tessera.sources import contracts as c

_FOLDER = Path(__file__).parent / "contracts"
ORDERS = c.load(_FOLDER / "orders.json")
EVENTS = c.load(_FOLDER / "events.json")
LABELS = c.load(_FOLDER / "labels.json")
ALL = [ORDERS, EVENTS, LABELS]

LABEL_CHECKS = ("quality in [0, 1]", "toxic in [0]", "duplicate_count(doc_id) = 0")
ORDERS_AS_OF = "1998-01-08"
EVENTS_AS_OF = "2024-01-31"
RETENTION_AS_OF = "2001-08-01"


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def contract_columns(spark, sf):
    """Declared columns beside the rows that fill them."""
    filled = []
    for contract in ALL:
        for table, specs in contract.tables.items():
            df = read_table(spark, sf, table)
            delivered = [s.name for s in specs if s.name in df.columns]
            filled.append(quality.completeness(df, table, delivered))
    declared = c.column_table(spark, ALL).select("contract", "table_name", "column_name", "declared_type", "required")
    facts = _stack(filled).select("table_name", "column_name", "filled_rows")
    return declared.join(facts, ["table_name", "column_name"], "left")


def contract_checks(spark, sf):
    """Every declared check with its verdict."""
    reports = [
        quality.contract_report(read_table(spark, sf, table), k, table).withColumn("contract", F.lit(k.id))
        for k in ALL
        for table in k.checks
    ]
    return c.check_table(spark, ALL).join(_stack(reports), ["contract", "table_name", "check_text"])


def dq_report(spark, sf):
    return quality.contract_report(read_table(spark, sf, "lineitem"), ORDERS, "lineitem")


def dq_duplicates(spark, sf):
    return quality.duplicate_groups(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_valid_values(spark, sf):
    return quality.check_report(read_table(spark, sf, "labels"), "labels", LABEL_CHECKS)


def sla_freshness(spark, sf):
    promised = [(ORDERS, "orders", ORDERS_AS_OF), (EVENTS, "events", EVENTS_AS_OF)]
    return _stack(
        [
            quality.freshness(
                read_table(spark, sf, table),
                table,
                contract.promise("freshness").column,
                as_of,
                contract.promise("freshness").value,
            )
            for contract, table, as_of in promised
        ]
    )


def retention_split(spark, sf):
    period = ORDERS.promise("retention").value
    parts = [("orders", "o_orderdate"), ("lineitem", "l_shipdate")]
    return _stack(
        [quality.retention_split(read_table(spark, sf, t), t, col, RETENTION_AS_OF, period) for t, col in parts]
    )


def retained_rows(spark, sf):
    kept = quality.retained(
        read_table(spark, sf, "orders"), "o_orderdate", RETENTION_AS_OF, ORDERS.promise("retention").value
    )
    return kept.select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))


def completeness(spark, sf):
    """Labels laid over all documents: how much of the collection is judged."""
    documents = read_table(spark, sf, "documents").select("doc_id", "lang")
    judged = documents.join(read_table(spark, sf, "labels"), "doc_id", "left")
    return quality.completeness(judged, "documents", ["doc_id", "lang", "quality", "toxic"])


def schema_conformance(spark, sf):
    parts = [(ORDERS, "orders"), (ORDERS, "lineitem"), (EVENTS, "events"), (LABELS, "labels")]
    return _stack(
        [quality.schema_conformance(read_table(spark, sf, table), table, k.columns(table)) for k, table in parts]
    )


def promise_states(spark, sf):
    """Every promise of every contract beside what the tables show; null where tables cannot tell."""
    as_of = {ORDERS.id: ORDERS_AS_OF, EVENTS.id: EVENTS_AS_OF}
    seen = []
    for contract in (ORDERS, EVENTS):
        table = next(iter(contract.tables))
        df, column = read_table(spark, sf, table), contract.promise("freshness").column
        state = quality.freshness(df, table, column, as_of[contract.id], contract.promise("freshness").value)
        shown = [state.select(F.lit("freshness").alias("kind"), F.col("newest").cast("string").alias("observed"), F.col("fresh").alias("kept"))]
        state = quality.retention_split(df, table, column, RETENTION_AS_OF, contract.promise("retention").value)
        expired = F.col("expired_rows")
        shown.append(state.select(F.lit("retention").alias("kind"), expired.cast("string").alias("observed"), (expired == 0).alias("kept")))
        if promised := contract.promise("completeness"):
            least = F.min("completeness_pct")
            state = quality.completeness(df, table, [s.name for s in contract.columns(table)]).agg(least.alias("least"))
            enough = F.col("least") >= float(promised.value.rstrip("%"))
            shown.append(state.select(F.lit("completeness").alias("kind"), F.col("least").cast("string").alias("observed"), enough.alias("kept")))
        seen.append(_stack(shown).withColumn("contract", F.lit(contract.id)))
    promised = c.promise_table(spark, ALL).select("contract", "kind", "value", "description")
    owners = c.contract_table(spark, ALL).select("contract", "status", "owner")
    return promised.join(owners, "contract").join(_stack(seen), ["contract", "kind"], "left")


def governed_result(spark, sf):
    return quality.governed(retail.revenue_by_store(spark, sf), ORDERS)


def governance_lookup(spark, sf):
    return c.governance_lookup(read_table(spark, sf, "orders"), ORDERS, "orders", "o_orderdate")


QUERIES = {
    "contract_columns": contract_columns,
    "contract_checks": contract_checks,
    "dq_report": dq_report,
    "dq_duplicates": dq_duplicates,
    "dq_valid_values": dq_valid_values,
    "sla_freshness": sla_freshness,
    "retention_split": retention_split,
    "retained_rows": retained_rows,
    "completeness": completeness,
    "schema_conformance": schema_conformance,
    "governed_result": governed_result,
    "governance_lookup": governance_lookup,
    "promise_states": promise_states,
}


def _declared_columns() -> str:
    rows = [
        f"SELECT '{k.id}' AS contract, '{table}' AS table_name, '{s.name}' AS column_name, '{s.type}' AS declared_type, "
        f"{s.required} AS required, "
        + ("CAST(NULL AS BIGINT)" if s.name == "o_channel" else f"(SELECT COUNT({s.name}) FROM {table})")
        + " AS filled_rows"
        for k in ALL
        for table, specs in k.tables.items()
        for s in specs
    ]
    return "\nUNION ALL ".join(rows)


# Each check of the contracts as plain SQL (observed value, and whether it passes).
_CHECK_SQL = {
    "orders": {
        "row_count > 0": ("COUNT(*)", "> 0"),
        "duplicate_count(o_orderkey) = 0": ("MAX((SELECT COUNT(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1)))", "= 0"),
        "missing_count(o_custkey) = 0": ("COUNT(*) - COUNT(o_custkey)", "= 0"),
        "missing_count(o_orderdate) = 0": ("COUNT(*) - COUNT(o_orderdate)", "= 0"),
        "min(o_totalprice) > 0": ("MIN(o_totalprice)", "> 0"),
        "max(o_totalprice) < 400000": ("MAX(o_totalprice)", "< 400000"),
        "o_orderstatus in ['F', 'O']": ("COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", "= 0"),
    },
    "lineitem": {
        "row_count > 0": ("COUNT(*)", "> 0"),
        "duplicate_count(l_orderkey, l_linenumber) = 0": (
            "MAX((SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)))",
            "= 0",
        ),
        "missing_count(l_shipdate) = 0": ("COUNT(*) - COUNT(l_shipdate)", "= 0"),
        "min(l_quantity) >= 1": ("MIN(l_quantity)", ">= 1"),
        "max(l_discount) <= 0.1": ("MAX(l_discount)", "<= 0.1::DOUBLE"),
        "min(l_extendedprice) > 0": ("MIN(l_extendedprice)", "> 0"),
        "l_returnflag in ['A', 'N', 'R']": ("COUNT(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R'))", "= 0"),
    },
    "events": {
        "missing_count(user_id) = 0": ("COUNT(*) - COUNT(user_id)", "= 0"),
        "missing_count(value) = 0": ("COUNT(*) - COUNT(value)", "= 0"),
        "min(value) > 0": ("MIN(value)", "> 0"),
        "event_type in ['click', 'view', 'signup', 'purchase']": (
            "COUNT(*) FILTER (event_type NOT IN ('click', 'view', 'signup', 'purchase'))",
            "= 0",
        ),
        "row_count > 0": ("COUNT(*)", "> 0"),
    },
    "labels": {
        "quality in [0, 1]": ("COUNT(*) FILTER (quality NOT IN (0, 1))", "= 0"),
        "toxic in [0]": ("COUNT(*) FILTER (toxic NOT IN (0))", "= 0"),
        "duplicate_count(doc_id) = 0": ("MAX((SELECT COUNT(*) FROM (SELECT 1 FROM labels GROUP BY doc_id HAVING COUNT(*) > 1)))", "= 0"),
    },
}


def _checks_sql(*tables: str, extra: str = "") -> str:
    rows = []
    for table in tables:
        for text, (value, test) in _CHECK_SQL[table].items():
            label = text.replace("'", "''")
            rows.append(
                f"SELECT {extra.format(table=table)} '{table}' AS table_name, '{label}' AS check_text, "
                f"CAST({value} AS DOUBLE) AS observed, ({value}) {test} AS passed FROM {table}"
            )
    return "\nUNION ALL ".join(rows)


_CONTRACT_OF = "CASE '{table}' WHEN 'events' THEN 'urn:product:events:v1' ELSE 'urn:contract:orders:v1' END AS contract,"

_CONFORMS = (
    "SELECT '{t}' AS table_name, '{c}' AS column_name, '{d}' AS declared_type, {a} AS actual_type, {ok} AS type_ok, "
    "{nulls} AS null_rows, {good} AS conforms{source}"
)

# Fixed values: (table, column, declared type, actual type or None, fits, required).
_DECLARED = (
    ("orders", "o_orderkey", "number", "bigint", True, True),
    ("orders", "o_custkey", "number", "bigint", True, True),
    ("orders", "o_orderstatus", "string", "string", True, True),
    ("orders", "o_totalprice", "number", "double", True, True),
    ("orders", "o_orderdate", "date", "timestamp_ntz", True, True),
    ("orders", "o_channel", "string", None, False, False),
    ("lineitem", "l_orderkey", "number", "bigint", True, True),
    ("lineitem", "l_linenumber", "number", "int", True, True),
    ("lineitem", "l_quantity", "number", "double", True, True),
    ("lineitem", "l_discount", "string", "double", False, True),
    ("lineitem", "l_shipdate", "date", "timestamp_ntz", True, True),
    ("events", "event_id", "BIGINT", "bigint", True, False),
    ("events", "ts", "TIMESTAMP", "timestamp_ntz", True, False),
    ("events", "user_id", "BIGINT", "bigint", True, False),
    ("events", "event_type", "VARCHAR", "string", True, False),
    ("events", "value", "DOUBLE", "double", True, False),
    ("labels", "doc_id", "BIGINT", "bigint", True, False),
    ("labels", "quality", "INTEGER", "int", True, False),
    ("labels", "toxic", "INTEGER", "int", True, False),
)


def _conformance_sql() -> str:
    rows = []
    for table, column, declared, actual, fits, required in _DECLARED:
        counted = {
            "a": f"'{actual}'",
            "nulls": f"COUNT(*) - COUNT({column})",
            "good": f"{fits} AND COUNT(*) = COUNT({column})" if required else str(fits),
            "source": f" FROM {table}",
        }
        absent = {"a": "CAST(NULL AS VARCHAR)", "nulls": "CAST(NULL AS BIGINT)", "good": "FALSE", "source": ""}
        rows.append(_CONFORMS.format(t=table, c=column, d=declared, ok=fits, **(counted if actual else absent)))
    return "\nUNION ALL ".join(rows)


# What the contract file says about orders, written out by hand.
_FACTS = """
    ('title', 'Order Book Contract'), ('version', '1.0.0'), ('status', 'active'), ('owner', 'Order Desk'),
    ('contact', 'orders@example.org'), ('usage', 'Internal reporting.'), ('limitations', 'Not for external distribution.'),
    ('lineage', 'parquet:orders.parquet'), ('tags', 'retail, orders'),
    ('service level availability', '99.9%: During business hours'),
    ('service level retention', 'P3Y: Rolling three years'),
    ('service level freshness', 'P5D: Updated within 5 business days of each quarter end'),
    ('service level support', 'P1D: Answered within a day'), ('service level backup', 'P1D: Daily'),
    ('term usage', 'Internal reporting.'), ('term limitations', 'Not for external distribution.'), ('term noticePeriod', 'P3M')
"""
# The promises of the three contracts, written out by hand.
_PROMISES = """
    ('urn:contract:orders:v1', 'availability', '99.9%', 'During business hours', 'active', 'Order Desk'),
    ('urn:contract:orders:v1', 'retention', 'P3Y', 'Rolling three years', 'active', 'Order Desk'),
    ('urn:contract:orders:v1', 'freshness', 'P5D', 'Updated within 5 business days of each quarter end', 'active', 'Order Desk'),
    ('urn:contract:orders:v1', 'support', 'P1D', 'Answered within a day', 'active', 'Order Desk'),
    ('urn:contract:orders:v1', 'backup', 'P1D', 'Daily', 'active', 'Order Desk'),
    ('urn:product:events:v1', 'freshness', 'T+1', 'Loaded each business day', 'active', 'Web Team'),
    ('urn:product:events:v1', 'completeness', '100%', 'All events captured', 'active', 'Web Team'),
    ('urn:product:events:v1', 'retention', 'P3Y', 'not specified', 'active', 'Web Team'),
    ('document_labels', 'refresh', 'quarterly', 'not specified', 'not specified', 'labels@example.org')
"""


def _working_days(after: str, upto: str) -> str:
    """SQL for the Mondays to Fridays after one date and up to another."""
    return f"(SELECT COUNT(*) FROM generate_series({after} + INTERVAL 1 DAY, {upto}, INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6)"


# The newest quarter end that five working days have passed since, and the working day before a date.
_DUE_SQL = f"""
    due AS (
        SELECT 'orders' AS table_name, 'P5D' AS promise, MAX(CAST(d AS DATE)) AS required
        FROM generate_series(DATE '1997-01-01', DATE '{ORDERS_AS_OF}', INTERVAL 1 DAY) t(d)
        WHERE month(d + INTERVAL 1 DAY) IN (1, 4, 7, 10) AND day(d + INTERVAL 1 DAY) = 1
          AND {_working_days("d", f"DATE '{ORDERS_AS_OF}'")} >= 5
        UNION ALL
        SELECT 'events', 'T+1', MAX(CAST(d AS DATE))
        FROM generate_series(DATE '2024-01-01', DATE '{EVENTS_AS_OF}', INTERVAL 1 DAY) t(d)
        WHERE isodow(d) < 6 AND {_working_days("d", f"DATE '{EVENTS_AS_OF}'")} >= 1)"""
_NEWEST_SQL = f"""
    newest AS (
        SELECT 'orders' AS table_name, CAST(MAX(o_orderdate) AS DATE) AS newest
        FROM orders WHERE o_orderdate < DATE '{ORDERS_AS_OF}' + INTERVAL 1 DAY
        UNION ALL
        SELECT 'events', CAST(MAX(ts) AS DATE) FROM events WHERE ts < DATE '{EVENTS_AS_OF}' + INTERVAL 1 DAY)"""


ORACLE = {
    "contract_columns": _declared_columns(),
    "contract_checks": _checks_sql("orders", "lineitem", "events", extra=_CONTRACT_OF),
    "dq_report": _checks_sql("lineitem"),
    "dq_duplicates": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
    "dq_valid_values": _checks_sql("labels"),
    "sla_freshness": f"""
        WITH {_DUE_SQL}, {_NEWEST_SQL}
        SELECT table_name, promise, required, newest, newest >= required AS fresh,
               CAST(GREATEST(date_diff('day', newest, required), 0) AS INTEGER) AS days_late
        FROM due JOIN newest USING (table_name)""",
    "retention_split": """
        SELECT 'orders' AS table_name, COUNT(*) FILTER (o_orderdate >= DATE '1998-08-01') AS retained_rows,
               COUNT(*) FILTER (o_orderdate < DATE '1998-08-01') AS expired_rows,
               COUNT(*) FILTER (o_orderdate IS NULL) AS undated_rows FROM orders
        UNION ALL
        SELECT 'lineitem', COUNT(*) FILTER (l_shipdate >= DATE '1998-08-01'),
               COUNT(*) FILTER (l_shipdate < DATE '1998-08-01'), COUNT(*) FILTER (l_shipdate IS NULL) FROM lineitem""",
    "retained_rows": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered FROM orders
        WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 3 YEAR""",
    "completeness": """
        WITH judged AS (SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
        SELECT 'documents' AS table_name, 'doc_id' AS column_name, COUNT(doc_id) AS filled_rows,
               COUNT(doc_id) / CAST(COUNT(*) AS DOUBLE) * 100 AS completeness_pct FROM judged
        UNION ALL SELECT 'documents', 'lang', COUNT(lang), COUNT(lang) / CAST(COUNT(*) AS DOUBLE) * 100 FROM judged
        UNION ALL SELECT 'documents', 'quality', COUNT(quality), COUNT(quality) / CAST(COUNT(*) AS DOUBLE) * 100
            FROM judged
        UNION ALL SELECT 'documents', 'toxic', COUNT(toxic), COUNT(toxic) / CAST(COUNT(*) AS DOUBLE) * 100
            FROM judged""",
    "schema_conformance": _conformance_sql(),
    "governed_result": f"""
        SELECT *, 'Order Desk' AS data_owner, 'active' AS data_status,
               'Updated within 5 business days of each quarter end' AS freshness_promise
        FROM ({retail.ORACLE["revenue_by_store"]})""",
    "governance_lookup": f"""
        SELECT 'orders' AS table_name, (SELECT COUNT(*) FROM orders) AS table_rows,
               (SELECT CAST(MAX(o_orderdate) AS VARCHAR) FROM orders) AS newest, field, value
        FROM (VALUES {_FACTS}) f(field, value)""",
    "promise_states": f"""
        WITH {_DUE_SQL}, {_NEWEST_SQL}, seen AS (
            SELECT CASE table_name WHEN 'orders' THEN 'urn:contract:orders:v1' ELSE 'urn:product:events:v1' END AS contract,
                   'freshness' AS kind, CAST(newest AS VARCHAR) AS observed, newest >= required AS kept
            FROM due JOIN newest USING (table_name)
            UNION ALL SELECT 'urn:contract:orders:v1', 'retention', CAST(COUNT(*) FILTER (o_orderdate < DATE '1998-08-01') AS VARCHAR),
                   COUNT(*) FILTER (o_orderdate < DATE '1998-08-01') = 0 FROM orders
            UNION ALL SELECT 'urn:product:events:v1', 'retention', CAST(COUNT(*) FILTER (ts < DATE '1998-08-01') AS VARCHAR),
                   COUNT(*) FILTER (ts < DATE '1998-08-01') = 0 FROM events
            UNION ALL SELECT 'urn:product:events:v1', 'completeness', CAST(least AS VARCHAR), least >= 100 FROM (
                SELECT LEAST(COUNT(event_id), COUNT(ts), COUNT(user_id), COUNT(event_type), COUNT(value))
                       / CAST(COUNT(*) AS DOUBLE) * 100 AS least FROM events))
        SELECT p.*, observed, kept
        FROM (VALUES {_PROMISES}) p(contract, kind, value, description, status, owner) LEFT JOIN seen USING (contract, kind)""",
}
