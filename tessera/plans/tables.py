"""The test tables, and the semantic models over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import quarter_end
from tessera.functions.numbers import percent
from tessera.operators.semantic import Field, Join, SemanticModel, SemanticQuery, run
from tessera.sources.catalog import scan

# The columns of the tables, so that no job is spent on inferring them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{folder}/{name}.parquet", SCHEMAS[name])


def region(spark: SparkSession, sf: str) -> SemanticModel:
    return SemanticModel.from_frame("region", read_table(spark, sf, "region"), primary_key=["r_regionkey"])


def nation(spark: SparkSession, sf: str) -> SemanticModel:
    return SemanticModel.from_frame(
        "nation",
        read_table(spark, sf, "nation"),
        primary_key=["n_nationkey"],
        joins=[Join("region", lambda: region(spark, sf), "n_regionkey", "r_regionkey")],
    )


def customer(spark: SparkSession, sf: str) -> SemanticModel:
    return SemanticModel.from_frame(
        "customer",
        read_table(spark, sf, "customer"),
        primary_key=["c_custkey"],
        exact={"c_acctbal": 2},
        joins=[Join("nation", lambda: nation(spark, sf), "c_nationkey", "n_nationkey")],
    )


def orders(spark: SparkSession, sf: str) -> SemanticModel:
    """Orders with their customer, whose nation stands for the store."""
    return SemanticModel(
        "orders",
        read_table(spark, sf, "orders"),
        fields=(
            Field("order_id", "o_orderkey", primary_key=True),
            Field("customer_id", "o_custkey"),
            Field("status", "o_orderstatus"),
            Field("order_total", "o_totalprice", exact=2),
            Field("settled_total", "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END", hidden=True, exact=2),
            Field("ordered_at", "o_orderdate"),
            Field("priority", "o_orderpriority"),
        ),
        joins=(Join("customer", lambda: customer(spark, sf), "customer_id", "c_custkey", preaggregate=True),),
        time_dimension="ordered_at",
    )


def items(spark: SparkSession, sf: str) -> SemanticModel:
    def parts() -> SemanticModel:
        return SemanticModel.from_frame("part", read_table(spark, sf, "part"), primary_key=["p_partkey"])

    return SemanticModel.from_frame(
        "items",
        read_table(spark, sf, "lineitem"),
        primary_key=["l_orderkey", "l_linenumber"],
        exact={"l_extendedprice": 2, "l_quantity": 2},
        joins=[Join("part", parts, "l_partkey", "p_partkey", preaggregate=True)],
        time_dimension="l_shipdate",
    )


def capital_position(spark: SparkSession, sf: str, decimals: bool = False) -> DataFrame:
    """One row per nation and quarter end: settled amount as capital, all amounts as assets.

    With ``decimals`` the amounts stay decimals, for sums further on.
    """
    totals = run(
        orders(spark, sf),
        SemanticQuery.of(
            measures=["settled_total:sum", "order_total:sum"],
            dimensions=["customer.nation.n_name", "ordered_at__quarter"],
        ),
        decimals,
    )
    amounts = totals.select(
        quarter_end(F.col("ordered_at__quarter")).alias("reporting_date"),
        F.col("customer_nation_n_name").alias("entity"),
        F.col("settled_total_sum").alias("cet1_capital_mm"),
        F.col("order_total_sum").alias("rwa_mm"),
    )
    return amounts.select(
        "*", percent("cet1_capital_mm", "rwa_mm").alias("cet1_ratio_pct"), F.lit(9.75).alias("combined_buffer")
    )


# The same table for the SQL side; queries add their own SELECT.
CAPITAL_SQL = """
WITH totals AS (
    SELECT CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS reporting_date,
           n_name AS entity,
           CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
               AS cet1_capital_mm,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS rwa_mm
    FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
),
capital_position AS (
    SELECT *, cet1_capital_mm / NULLIF(rwa_mm, 0) * 100 AS cet1_ratio_pct, CAST(9.75 AS DOUBLE) AS combined_buffer
    FROM totals
)
"""
