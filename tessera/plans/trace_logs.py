"""Trace logs made from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import truncate
from tessera.operators import sketches, traces
from tessera.plans.tables import read_table
from tessera.session import materialise, new_path
from tessera.sources.records import write_records
from tessera.sources.traces import read_trace

LINE_SCHEMA = """
    event string, timestamp timestamp_ntz, latency_ms double, raw_args string, rows bigint,
    lineage_source array<string>, data array<map<string,string>>
"""
QUANTILES = (0.5, 0.95)


def trace(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a JSON-lines log, written and read back under the log's schema."""
    events = read_table(spark, sf, "events")
    purchase = F.col("event_type") == "purchase"
    lines = events.select(
        F.col("event_type").alias("event"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("latency_ms"),
        F.col("props").alias("raw_args"),
        F.when(purchase, F.lit(2).cast("bigint")).alias("rows"),
        F.when(purchase, F.array(F.lit("orders"), F.concat(F.lit("user_"), F.col("user_id").cast("string")))).alias(
            "lineage_source"
        ),
        F.when(
            purchase,
            F.array(
                F.create_map(F.lit("user"), F.col("user_id").cast("string")),
                F.create_map(F.lit("event"), F.col("event_id").cast("string")),
            ),
        ).alias("data"),
    )
    path = new_path(spark, "trace")
    write_records(lines, path)
    return read_trace(spark, path, LINE_SCHEMA)


def trace_scan(spark, sf):
    return trace(spark, sf).select("event", "timestamp", "latency_ms", "raw_args", "rows")


def trace_events(spark, sf):
    calls = traces.events(read_table(spark, sf, "events"), "error", "purchase", column="event_type")
    return calls.select("event_id", "event_type", "ts")


def trace_sql_arg(spark, sf):
    """The arguments of each event as a tool call: with ``sql``, with ``query``, or as they are."""
    given = F.when(F.col("event_type") == "click", F.concat(F.lit('{"sql": "user '), "user_id", F.lit('", "query": "x"}')))
    given = given.when(F.col("event_type") == "view", F.concat(F.lit('{"sql": "", "query": "event '), "event_id", F.lit('"}')))
    calls = read_table(spark, sf, "events").select("event_id", given.otherwise(F.col("props")).alias("arguments"))
    return traces.tool_arguments(calls, "arguments", "argument").drop("arguments")


def trace_lineage(spark, sf):
    return traces.lineage(trace(spark, sf))


def trace_result_rows(spark, sf):
    found = traces.result_rows(trace(spark, sf))
    record = F.col("record")
    return found.select(
        "timestamp", "rows", "position", record["user"].alias("user"), record["event"].alias("event_id")
    )


def trace_typed_rows(spark, sf):
    """Result records with a nested part, written as JSON and read back with their types."""
    purchases = read_table(spark, sf, "events").where(F.col("event_type") == "purchase")
    record = F.struct(
        F.col("user_id").alias("user"),
        F.struct(F.col("event_id").alias("id"), F.col("value").alias("amount")).alias("event"),
        (F.col("value") >= 50).alias("large"),
    )
    lines = purchases.select(
        F.col("event_type").alias("event"), F.col("ts").alias("timestamp"), F.lit(1).cast("bigint").alias("rows"),
        F.array(record).alias("data"),
    )
    path = new_path(spark, "typed-trace")
    write_records(lines, path)
    fields = {
        "user": ("$.user", "bigint"), "event_id": ("$.event.id", "bigint"), "amount": ("$.event.amount", "double"),
        "large": ("$.large", "boolean"),
    }
    trace = read_trace(spark, path, "event string, timestamp timestamp_ntz, rows bigint, data variant")
    return traces.typed_rows(trace, fields).drop("event")


def trace_latency_months(spark, sf):
    """Latency by month from sketches stored by day. The marks differ from run to run within the stated error, so
    what is reported is their count, the exact ends, and whether each mark's rank holds against all values."""
    events = read_table(spark, sf, "events").select("event_type", "value", F.col("ts").cast("date").alias("day"))
    keys = {"event_type": F.col("event_type"), "day": F.col("day")}
    days = sketches.store(events, keys, "value", new_path(spark, "latency-days"))
    months = {"event_type": F.col("event_type"), "month": truncate(F.col("day"), "month")}
    # Written, as a mark must be the same wherever it is read.
    marks = materialise(sketches.quantiles(sketches.merge(days, months), (0, *QUANTILES, 1)), "latency-months")
    values = events.select(*[c.alias(f"of_{name}") for name, c in months.items()], "value")
    same = F.col("event_type").eqNullSafe(F.col("of_event_type")) & F.col("month").eqNullSafe(F.col("of_month"))
    met = marks.join(values, same, "left").groupBy(*months, "n", "p0", "p50", "p95", "p100")
    error, checks = 2 * sketches.rank_error(), {}
    for q in QUANTILES:
        mark = F.col(f"p{q * 100:g}")
        below, upto = F.count_if(F.col("value") < mark), F.count_if(F.col("value") <= mark)
        checks[f"{q * 100:g}"] = (below <= F.lit(q + error) * F.col("n")) & (upto >= F.lit(q - error) * F.col("n"))
    held = met.agg(*[c.alias(f"p{name}_within_error") for name, c in checks.items()])
    return held.drop("p50", "p95").withColumnsRenamed({"p0": "lowest", "p100": "highest"})


def trace_latency(spark, sf):
    stats = traces.latency(read_table(spark, sf, "events"), "event_type", "value", QUANTILES)
    rounded = {c: F.round(c, 6) for c in ("avg_latency", "p50_latency", "p95_latency")}
    return stats.withColumns(rounded)


QUERIES = {
    "trace_scan": trace_scan,
    "trace_events": trace_events,
    "trace_sql_arg": trace_sql_arg,
    "trace_lineage": trace_lineage,
    "trace_result_rows": trace_result_rows,
    "trace_latency": trace_latency,
    "trace_typed_rows": trace_typed_rows,
    "trace_latency_months": trace_latency_months,
}

ORACLE = {
    "trace_scan": """
        SELECT event_type AS event, ts AS timestamp, value AS latency_ms, props AS raw_args,
               CASE WHEN event_type = 'purchase' THEN 2::BIGINT END AS rows
        FROM events""",
    "trace_events": "SELECT event_id, event_type, ts FROM events WHERE event_type IN ('error', 'purchase')",
    "trace_sql_arg": """
        SELECT event_id, CASE event_type WHEN 'click' THEN 'user ' || user_id WHEN 'view' THEN 'event ' || event_id
                         ELSE props->>'$.k' END AS argument
        FROM events""",
    "trace_lineage": """
        SELECT event_type AS event, ts AS timestamp, NULL AS source FROM events WHERE event_type <> 'purchase'
        UNION ALL
        SELECT event_type, ts, UNNEST(['orders', 'user_' || user_id]) FROM events WHERE event_type = 'purchase'""",
    "trace_result_rows": """
        SELECT ts AS timestamp, 2::BIGINT AS rows, 0 AS position, CAST(user_id AS VARCHAR) AS user,
               CAST(NULL AS VARCHAR) AS event_id FROM events WHERE event_type = 'purchase'
        UNION ALL
        SELECT ts, 2, 1, NULL, CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'purchase'""",
    "trace_latency": """
        SELECT event_type, COUNT(value) AS n, ROUND(AVG(value), 6) AS avg_latency, MAX(value) AS max_latency,
               ROUND(QUANTILE_CONT(value, 0.5), 6) AS p50_latency, ROUND(QUANTILE_CONT(value, 0.95), 6) AS p95_latency
        FROM events GROUP BY ALL""",
    "trace_typed_rows": """
        SELECT ts AS timestamp, 1::BIGINT AS rows, 0 AS position, user_id AS user, event_id, value AS amount,
               value >= 50 AS large
        FROM events WHERE event_type = 'purchase'""",
    "trace_latency_months": """
        SELECT event_type, CAST(DATE_TRUNC('month', ts) AS DATE) AS month, COUNT(value) AS n, MIN(value) AS lowest,
               MAX(value) AS highest, TRUE AS p50_within_error, TRUE AS p95_within_error
        FROM events GROUP BY ALL""",
}
