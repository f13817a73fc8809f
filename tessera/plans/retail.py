"""Semantic queries over orders, customers, items and nations."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numbers import decimals_as_doubles
from tessera.operators import rollups, semantic
from tessera.operators.exposure import within_last
from tessera.operators.rollups import Rollups
from tessera.operators.semantic import Join, SemanticQuery, run
from tessera.plans import tables
from tessera.plans.tables import read_table
from tessera.session import new_path
from tessera.sources.catalog import Catalog, governed_sql, save_colocated
from tessera.sources.records import write_records
from tessera.sources.spine import spine_over

GOVERNED_TEXT = """
SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS largest
FROM orders WHERE o_orderstatus = 'O' GROUP BY o_orderpriority
"""

# A request as callers send it: bare strings, objects, and parts to be dropped.
REQUEST = """
{"source_model": "orders", "measures": ["order_total:sum", {"formula": "*:count", "name": "placed"}],
 "dimensions": ["priority", {"name": "ordered_at", "granularity": "year"}],
 "filters": [], "order": [{"column": "order_total_sum", "direction": "desc"}], "limit": 0}
"""


def _ask(spark: SparkSession, sf: str, **request) -> DataFrame:
    return decimals_as_doubles(run(tables.orders(spark, sf), SemanticQuery.of(**request)))


def scan_orders(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def row_count(spark, sf):
    counts = [
        read_table(spark, sf, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in ("orders", "lineitem", "events")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def time_spine(spark, sf):
    return spine_over(read_table(spark, sf, "orders"), "o_orderdate")


def model_columns(spark, sf):
    return semantic.column_profile(tables.orders(spark, sf))


def describe_model(spark, sf):
    return semantic.describe_live(tables.orders(spark, sf))


def json_records(spark, sf):
    typed = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.col("o_orderdate").cast("date").alias("ordered"),
        "o_orderstatus",
    )
    path = new_path(spark, "json-records")
    write_records(typed, path)
    return spark.read.text(path).select(F.col("value").alias("record"))


def governed(spark, sf):
    return governed_sql(spark, {"orders": f"{sf}/orders.parquet"}, GOVERNED_TEXT)


def project_columns(spark, sf):
    return read_table(spark, sf, "orders").select("o_totalprice", "o_orderstatus")


def cast_projection(spark, sf):
    return read_table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
    )


def filter_eq(spark, sf):
    return _ask(spark, sf, measures=["*:count", "order_total:sum"], filters=["priority = '1-URGENT'"])


def filter_range(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["*:count"],
        dimensions=["status"],
        filters=["ordered_at > '1998-06-01'", "order_total > 50"],
    )


def filter_conjunction(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["*:count", "order_total:max"],
        dimensions=["priority"],
        filters=["status = 'O'", "order_total > 100000", "customer.c_mktsegment = 'MACHINERY'"],
    )


def placed_last_n_days(spark, sf):
    placed = read_table(spark, sf, "orders").where(within_last(F.col("o_orderdate"), "1998-01-01", 30))
    return placed.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("ordered"), "o_totalprice")


def normalise_query(spark, sf):
    catalog = Catalog({"orders": tables.orders(spark, sf)})
    return decimals_as_doubles(catalog.query(json.loads(REQUEST)))


def revenue_by_store(spark, sf):
    return _ask(spark, sf, measures=["order_total:sum"], dimensions=["customer.nation.n_name"])


def revenue_by_region_multihop(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["order_total:sum", "*:count"],
        dimensions=["customer.nation.region.r_name", "customer.c_mktsegment"],
    )


def revenue_colocated(spark, sf):
    """Orders and customers stored by customer: summed per customer and joined where they lie."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"{name}_{uuid.uuid4().hex}" for name in ("orders", "customer")]
    frames = [(read_table(spark, sf, "orders"), ["o_custkey"]), (read_table(spark, sf, "customer"), ["c_custkey"])]
    stored = save_colocated(dict(zip(names, frames, strict=True)), buckets, new_path(spark, "colocated"))
    facts, buyers = (stored[name] for name in names)
    for name in names:  # the frames know their files; the names served this query alone
        spark.sql(f"DROP TABLE `{name}`")
    customer = replace(tables.customer(spark, sf), frame=buyers)
    joins = (Join("customer", customer, "customer_id", "c_custkey", preaggregate=True),)
    model = replace(tables.orders(spark, sf), frame=facts, joins=joins)
    asked = SemanticQuery.of(measures=["order_total:sum", "order_total:max", "*:count"], dimensions=["customer.c_mktsegment", "status"])
    return decimals_as_doubles(run(model, asked))


def measure_count(spark, sf):
    return _ask(spark, sf, measures=["*:count"], dimensions=["status"])


def measure_sum(spark, sf):
    return _ask(spark, sf, measures=["order_total:sum"], dimensions=["status"])


def measure_avg(spark, sf):
    return _ask(spark, sf, measures=["order_total:avg"], dimensions=["customer.nation.n_name"])


def measure_max(spark, sf):
    return _ask(spark, sf, measures=["order_total:max", "ordered_at:max"], dimensions=["priority"])


def measure_min(spark, sf):
    return _ask(spark, sf, measures=["order_total:min", "ordered_at:min"], dimensions=["priority"])


def formula_ratio(spark, sf):
    return _ask(
        spark,
        sf,
        measures=[{"formula": "order_total:sum / *:count", "name": "revenue_per_order"}],
        dimensions=["customer.nation.n_name"],
    )


def formula_difference(spark, sf):
    return _ask(
        spark,
        sf,
        measures=[{"formula": "order_total:max - order_total:min", "name": "spread"}],
        dimensions=["customer.nation.n_name"],
    )


def global_measures(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["*:count", "order_total:sum", "order_total:max", "order_total:avg"],
        order=[{"column": "count", "direction": "desc"}],
    )


def measures_by_dim(spark, sf):
    return _ask(spark, sf, measures=["*:count", "order_total:sum"], dimensions=["status", "ordered_at__month"])


def items_by_brand(spark, sf):
    query = SemanticQuery.of(measures=["*:count", "l_extendedprice:sum"], dimensions=["part.p_brand"])
    return decimals_as_doubles(run(tables.items(spark, sf), query))


def having_count(spark, sf):
    return _ask(spark, sf, measures=["*:count"], dimensions=["customer_id"], having=["count > 15"])


def cumsum_count(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["*:count", "cumsum(*:count)"],
        dimensions=["ordered_at__month", "status"],
    )


def cumsum_exact_time(spark, sf):
    """The time dimension without a grain, so that the series is as long as the data."""
    return _ask(spark, sf, measures=["cumsum(*:count)"], dimensions=["ordered_at", "status"])


def change_count(spark, sf):
    return _ask(spark, sf, measures=["*:count", "change(*:count)"], dimensions=["ordered_at__month"])


def order_by_measure(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["order_total:sum"],
        dimensions=["customer.nation.n_name", "status"],
        order=[{"column": "order_total:sum", "direction": "desc"}],
    )


def top_k_stores(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["order_total:sum"],
        dimensions=["customer.nation.n_name"],
        order=[{"column": "order_total_sum", "direction": "desc"}],
        limit=3,
    )


def top_customers(spark, sf):
    return _ask(
        spark,
        sf,
        measures=["order_total:sum", "*:count"],
        dimensions=["customer_id", "customer.c_name"],
        order=["-order_total_sum"],
        limit=10,
    )


def join_key_check(spark, sf):
    """Parts named by several items: the join from parts to items would multiply rows."""
    parts = tables.items(spark, sf)
    reverse = semantic.Join("items", parts, "p_partkey", "l_partkey")
    model = semantic.SemanticModel.from_frame("part", read_table(spark, sf, "part"), joins=[reverse])
    return semantic.duplicate_join_keys(model, "items")


def _stored_days(spark: SparkSession, sf: str) -> Rollups:
    """Orders with two roll-ups: days by priority, partitioned by year, and months by region."""
    model = tables.orders(spark, sf)
    measures = ["order_total:avg", "order_total:max", "*:count"]
    days = SemanticQuery.of(measures, ["ordered_at__day", "priority", "ordered_at__year"])
    months = SemanticQuery.of(["order_total:sum"], ["ordered_at__month", "customer.nation.region.r_name"])
    return Rollups(model, [
        rollups.store(model, days, new_path(spark, "rollup-days"), "ordered_at__year"),
        rollups.store(model, months, new_path(spark, "rollup-months")),
    ])


def rollup_by_month(spark, sf):
    """A request by month, with an average, answered from stored days."""
    out = _stored_days(spark, sf).query(
        {"measures": ["order_total:sum", "order_total:avg", "order_total:max", "*:count"], "dimensions": ["ordered_at__month", "priority"],
         "filters": ["priority <> '5-LOW'"]}
    )
    return decimals_as_doubles(out).withColumn("order_total_avg", F.round("order_total_avg", 4))


def rollup_by_region(spark, sf):
    """Two requests over what is stored: quarters of one region, and regions with a large total."""
    return decimals_as_doubles(_stored_days(spark, sf).query(
        {"measures": ["order_total:sum"], "dimensions": ["ordered_at__quarter", "customer.nation.region.r_name"],
         "filters": ["customer.nation.region.r_name IN ('ASIA', 'EUROPE')"], "having": ["order_total_sum > 1000"]}
    ))


def rollup_refreshed(spark, sf):
    """Years stored from all but the last year's orders, then the last two years worked out anew."""
    model = tables.orders(spark, sf)
    last = model.logical().agg(F.max("ordered_at").cast("date")).first()[0]
    query = SemanticQuery.of(["order_total:sum", "*:count"], ["ordered_at__month", "ordered_at__year"])
    if last is None:
        return decimals_as_doubles(run(model, query))
    early = replace(model, frame=model.frame.where(F.col("o_orderdate") < F.lit(f"{last.year}-01-01").cast("timestamp_ntz")))
    kept = rollups.store(early, query, new_path(spark, "rollup-years"), "ordered_at__year")
    late = rollups.refresh(replace(kept, model=model), [f"{last.year - 1}-01-01", f"{last.year}-01-01"])
    return decimals_as_doubles(rollups.answer(model, query, [late]))


QUERIES = {
    "rollup_by_month": rollup_by_month,
    "rollup_by_region": rollup_by_region,
    "rollup_refreshed": rollup_refreshed,
    "scan_orders": scan_orders,
    "row_count": row_count,
    "time_spine": time_spine,
    "model_columns": model_columns,
    "describe_model": describe_model,
    "json_records": json_records,
    "governed_sql": governed,
    "project_columns": project_columns,
    "cast_projection": cast_projection,
    "filter_eq": filter_eq,
    "filter_range": filter_range,
    "filter_conjunction": filter_conjunction,
    "placed_last_n_days": placed_last_n_days,
    "normalise_query": normalise_query,
    "revenue_by_store": revenue_by_store,
    "revenue_colocated": revenue_colocated,
    "revenue_by_region_multihop": revenue_by_region_multihop,
    "measure_count": measure_count,
    "measure_sum": measure_sum,
    "measure_avg": measure_avg,
    "measure_max": measure_max,
    "measure_min": measure_min,
    "formula_ratio": formula_ratio,
    "formula_difference": formula_difference,
    "global_measures": global_measures,
    "measures_by_dim": measures_by_dim,
    "items_by_brand": items_by_brand,
    "having_count": having_count,
    "cumsum_count": cumsum_count,
    "cumsum_exact_time": cumsum_exact_time,
    "change_count": change_count,
    "order_by_measure": order_by_measure,
    "top_k_stores": top_k_stores,
    "top_customers": top_customers,
    "join_key_check": join_key_check,
}

_TOTAL = "SUM(CAST(o_totalprice AS DECIMAL(18,2)))"
_STORE = "FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"

ORACLE = {
    "rollup_by_month": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ordered_at__month, o_orderpriority AS priority,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_total_sum,
               ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice), 4) AS order_total_avg,
               MAX(o_totalprice) AS order_total_max, COUNT(*) AS count
        FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL""",
    "rollup_by_region": """
        SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS ordered_at__quarter, r_name AS customer_nation_region_r_name,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_total_sum
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL HAVING order_total_sum > 1000""",
    "rollup_refreshed": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ordered_at__month, CAST(date_trunc('year', o_orderdate) AS DATE) AS ordered_at__year,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_total_sum, COUNT(*) AS count
        FROM orders GROUP BY ALL""",
    "scan_orders": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "row_count": """
        SELECT 'orders' AS table_name, COUNT(*) AS n FROM orders
        UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
        UNION ALL SELECT 'events', COUNT(*) FROM events""",
    "time_spine": """
        SELECT CAST(UNNEST(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date_day
        FROM orders""",
    "model_columns": """
        SELECT 'order_id' AS column_name, 'bigint' AS data_type, FALSE AS visible, FALSE AS is_time_dimension,
               COUNT(o_orderkey) AS filled_rows FROM orders
        UNION ALL SELECT 'customer_id', 'bigint', TRUE, FALSE, COUNT(o_custkey) FROM orders
        UNION ALL SELECT 'status', 'string', TRUE, FALSE, COUNT(o_orderstatus) FROM orders
        UNION ALL SELECT 'order_total', 'double', TRUE, FALSE, COUNT(o_totalprice) FROM orders
        UNION ALL SELECT 'settled_total', 'double', FALSE, FALSE, COUNT(*) FILTER (o_orderstatus = 'F') FROM orders
        UNION ALL SELECT 'ordered_at', 'timestamp_ntz', TRUE, TRUE, COUNT(o_orderdate) FROM orders
        UNION ALL SELECT 'priority', 'string', TRUE, FALSE, COUNT(o_orderpriority) FROM orders""",
    "describe_model": """
        SELECT 'column' AS kind, 'customer_id' AS name, 'bigint' AS detail, FALSE AS is_time_dimension,
               COUNT(o_custkey) AS fact_rows FROM orders
        UNION ALL SELECT 'column', 'status', 'string', FALSE, COUNT(o_orderstatus) FROM orders
        UNION ALL SELECT 'column', 'order_total', 'double', FALSE, COUNT(o_totalprice) FROM orders
        UNION ALL SELECT 'column', 'ordered_at', 'timestamp_ntz', TRUE, COUNT(o_orderdate) FROM orders
        UNION ALL SELECT 'column', 'priority', 'string', FALSE, COUNT(o_orderpriority) FROM orders
        UNION ALL SELECT 'join', 'customer', 'customer', FALSE, COUNT(*)
            FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)""",
    "json_records": """
        SELECT CAST(to_json({'o_orderkey': o_orderkey,
                             'total': CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR),
                             'ordered': CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
                             'o_orderstatus': o_orderstatus}) AS VARCHAR) AS record
        FROM orders""",
    "governed_sql": GOVERNED_TEXT,
    "project_columns": "SELECT o_totalprice, o_orderstatus FROM orders",
    "cast_projection": """
        SELECT CAST(o_orderdate AS DATE) AS ordered, CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total
        FROM orders""",
    "filter_eq": f"""
        SELECT COUNT(*) AS count, CAST({_TOTAL} AS DOUBLE) AS order_total_sum
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "filter_range": """
        SELECT o_orderstatus AS status, COUNT(*) AS count FROM orders
        WHERE o_orderdate > '1998-06-01' AND o_totalprice > 50 GROUP BY ALL""",
    "filter_conjunction": """
        SELECT o_orderpriority AS priority, COUNT(*) AS count, MAX(o_totalprice) AS order_total_max
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'O' AND o_totalprice > 100000 AND c_mktsegment = 'MACHINERY' GROUP BY ALL""",
    "placed_last_n_days": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS ordered, o_totalprice FROM orders
        WHERE CAST(o_orderdate AS DATE) > DATE '1998-01-01' - INTERVAL 30 DAY
          AND CAST(o_orderdate AS DATE) <= DATE '1998-01-01'""",
    "normalise_query": f"""
        SELECT o_orderpriority AS priority, CAST(date_trunc('year', o_orderdate) AS DATE) AS ordered_at__year,
               CAST({_TOTAL} AS DOUBLE) AS order_total_sum, COUNT(*) AS placed
        FROM orders GROUP BY ALL""",
    "revenue_by_store": f"""
        SELECT n_name AS customer_nation_n_name, CAST({_TOTAL} AS DOUBLE) AS order_total_sum {_STORE} GROUP BY ALL""",
    "revenue_colocated": f"""
        SELECT c_mktsegment AS customer_c_mktsegment, o_orderstatus AS status, CAST({_TOTAL} AS DOUBLE) AS order_total_sum,
               MAX(o_totalprice) AS order_total_max, COUNT(*) AS count
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "revenue_by_region_multihop": f"""
        SELECT r_name AS customer_nation_region_r_name, c_mktsegment AS customer_c_mktsegment,
               CAST({_TOTAL} AS DOUBLE) AS order_total_sum, COUNT(*) AS count
        {_STORE} LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "measure_count": "SELECT o_orderstatus AS status, COUNT(*) AS count FROM orders GROUP BY ALL",
    "measure_sum": f"""
        SELECT o_orderstatus AS status, CAST({_TOTAL} AS DOUBLE) AS order_total_sum FROM orders GROUP BY ALL""",
    "measure_avg": f"""
        SELECT n_name AS customer_nation_n_name, CAST({_TOTAL} AS DOUBLE) / COUNT(o_totalprice) AS order_total_avg
        {_STORE} GROUP BY ALL""",
    "measure_max": """
        SELECT o_orderpriority AS priority, MAX(o_totalprice) AS order_total_max, MAX(o_orderdate) AS ordered_at_max
        FROM orders GROUP BY ALL""",
    "measure_min": """
        SELECT o_orderpriority AS priority, MIN(o_totalprice) AS order_total_min, MIN(o_orderdate) AS ordered_at_min
        FROM orders GROUP BY ALL""",
    "formula_ratio": f"""
        SELECT n_name AS customer_nation_n_name, CAST({_TOTAL} AS DOUBLE) / COUNT(*) AS revenue_per_order
        {_STORE} GROUP BY ALL""",
    "formula_difference": f"""
        SELECT n_name AS customer_nation_n_name, MAX(o_totalprice) - MIN(o_totalprice) AS spread
        {_STORE} GROUP BY ALL""",
    "global_measures": f"""
        SELECT COUNT(*) AS count, CAST({_TOTAL} AS DOUBLE) AS order_total_sum, MAX(o_totalprice) AS order_total_max,
               CAST({_TOTAL} AS DOUBLE) / COUNT(o_totalprice) AS order_total_avg
        FROM orders""",
    "measures_by_dim": f"""
        SELECT o_orderstatus AS status, CAST(date_trunc('month', o_orderdate) AS DATE) AS ordered_at__month,
               COUNT(*) AS count, CAST({_TOTAL} AS DOUBLE) AS order_total_sum
        FROM orders GROUP BY ALL""",
    "items_by_brand": """
        SELECT p_brand AS part_p_brand, COUNT(*) AS count,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice_sum
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "having_count": """
        SELECT o_custkey AS customer_id, COUNT(*) AS count FROM orders GROUP BY ALL HAVING COUNT(*) > 15""",
    "cumsum_count": """
        WITH monthly AS (
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ordered_at__month, o_orderstatus AS status,
                   COUNT(*) AS count
            FROM orders GROUP BY ALL)
        SELECT *, CAST(SUM(count) OVER (PARTITION BY status ORDER BY ordered_at__month) AS BIGINT) AS cumsum_count
        FROM monthly""",
    "cumsum_exact_time": """
        WITH daily AS (SELECT o_orderdate AS ordered_at, o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY ALL)
        SELECT ordered_at, status,
               CAST(SUM(n) OVER (PARTITION BY status ORDER BY ordered_at) AS BIGINT) AS cumsum_count
        FROM daily""",
    "change_count": """
        WITH monthly AS (
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ordered_at__month, COUNT(*) AS count
            FROM orders GROUP BY ALL)
        SELECT *, count - LAG(count) OVER (ORDER BY ordered_at__month) AS change_count FROM monthly""",
    "order_by_measure": f"""
        SELECT n_name AS customer_nation_n_name, o_orderstatus AS status, CAST({_TOTAL} AS DOUBLE) AS order_total_sum
        {_STORE} GROUP BY ALL ORDER BY order_total_sum DESC NULLS LAST""",
    "top_k_stores": f"""
        SELECT n_name AS customer_nation_n_name, CAST({_TOTAL} AS DOUBLE) AS order_total_sum
        {_STORE} GROUP BY ALL ORDER BY order_total_sum DESC NULLS LAST, 1 LIMIT 3""",
    "top_customers": f"""
        SELECT o_custkey AS customer_id, c_name AS customer_c_name, CAST({_TOTAL} AS DOUBLE) AS order_total_sum,
               COUNT(*) AS count
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        GROUP BY ALL ORDER BY order_total_sum DESC NULLS LAST, 1, 2 LIMIT 10""",
    "join_key_check": """
        SELECT l_partkey AS key, COUNT(*) AS rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
}
