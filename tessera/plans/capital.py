"""Capital positions per nation and quarter, and the named metrics over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numbers import percent
from tessera.operators import position
from tessera.operators.metrics import Dimension, Measure, Metric, MetricLayer, MetricModel, entity_duplicates
from tessera.operators.quality import formula_mismatches
from tessera.plans.tables import CAPITAL_SQL, capital_position, read_table
from tessera.session import new_path
from tessera.sources.catalog import save_model
from tessera.sources.spine import spine_over

MINIMUM_PCT = 30.0
BASE_DATE = "1997-09-30"


def capital_model(frame: DataFrame) -> MetricModel:
    return MetricModel(
        "capital_position",
        frame,
        measures=(
            Measure("cet1_capital_total", "sum", "cet1_capital_mm", exact=2),
            Measure("rwa_total", "sum", "rwa_mm", exact=2),
            Measure("cet1_ratio_avg", "average", "cet1_ratio_pct"),
            Measure("combined_buffer_avg", "average", "combined_buffer"),
            Measure("rwa_newest", "latest", "rwa_mm", exact=2),
        ),
        dimensions=(
            Dimension("reporting_date", "time", grain="month"),
            Dimension("entity"),
        ),
        entities={"bank_entity": "entity"},
        time_dimension="reporting_date",
    )


# Names and labels of the capital metrics.
CAPITAL_METRICS = (
    Metric("cet1_ratio", "CET1 Ratio (%)", "Average of the reported ratios.", measure="cet1_ratio_avg"),
    Metric(
        "combined_buffer_requirement",
        "Combined Buffer Requirement (%)",
        "Average of the required buffers.",
        measure="combined_buffer_avg",
    ),
    Metric("cet1_capital", "CET1 Capital (MM)", "Total capital; adds up all periods.", measure="cet1_capital_total"),
    Metric("rwa", "Risk-Weighted Assets (MM)", "Total assets; adds up all periods.", measure="rwa_total"),
    Metric("rwa_latest", "Newest Risk-Weighted Assets (MM)", "Assets on the newest date.", measure="rwa_newest"),
    Metric(
        "buffer_headroom",
        "Buffer Headroom (pp)",
        "Ratio above the buffer; negative headroom restricts distributions.",
        expr="cet1_ratio - combined_buffer_requirement",
    ),
    Metric(
        "weighted_cet1_ratio",
        "Weighted CET1 Ratio (%)",
        "Ratio of the summed capital to the summed assets.",
        expr="cet1_capital / rwa * 100",
    ),
)


def capital_layer(spark: SparkSession, sf: str) -> MetricLayer:
    return MetricLayer([capital_model(capital_position(spark, sf))], CAPITAL_METRICS)


def trading_layer(spark: SparkSession, sf: str) -> MetricLayer:
    """Two models that share nothing but their time axis."""
    orders = read_table(spark, sf, "orders")
    items = read_table(spark, sf, "lineitem")
    return MetricLayer(
        [
            MetricModel(
                "orders",
                orders,
                measures=(
                    Measure("order_rows", "count", "o_orderkey"),
                    Measure("order_amount", "sum", "o_totalprice", exact=2),
                    Measure(
                        "urgent_open",
                        "sum",
                        "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice END",
                        exact=2,
                    ),
                ),
                dimensions=(Dimension("ordered", "time", "o_orderdate"), Dimension("status", expr="o_orderstatus")),
                entities={"order": "o_orderkey"},
            ),
            MetricModel(
                "items",
                items,
                measures=(Measure("shipped_amount", "sum", "l_extendedprice", exact=2),),
                dimensions=(Dimension("shipped", "time", "l_shipdate"), Dimension("flag", expr="l_returnflag")),
            ),
        ],
        [
            Metric("order_count", "Orders", "Orders placed.", measure="order_rows"),
            Metric("ordered", "Ordered amount", "Amount of the orders placed.", measure="order_amount"),
            Metric("urgent", "Open urgent amount", "Open orders of the highest priority.", measure="urgent_open"),
            Metric("shipped", "Shipped amount", "Amount of the items shipped.", measure="shipped_amount"),
            Metric("shipped_share", "Shipped share", "Shipped against ordered.", expr="shipped / ordered"),
        ],
    )


def _doubles(df: DataFrame, *exact: str, **digits: int) -> DataFrame:
    """Money as double; averages, whose last digit depends on the order of adding, rounded."""
    for name in exact:
        df = df.withColumn(name, F.col(name).cast("double"))
    for name, places in digits.items():
        df = df.withColumn(name, F.round(name, places))
    return df


def model_capital_position(spark, sf):
    return save_model(capital_position(spark, sf), new_path(spark, "capital-position"))


def headroom(spark, sf):
    rows = capital_position(spark, sf)
    return rows.select(
        "reporting_date", "entity", position.headroom("cet1_ratio_pct", "combined_buffer").alias("buffer_headroom")
    )


def ratio_pct(spark, sf):
    return capital_position(spark, sf).select(
        "reporting_date", "entity", percent("cet1_capital_mm", "rwa_mm").alias("ratio_pct")
    )


def compliance_flag(spark, sf):
    margin = position.headroom("cet1_ratio_pct", "combined_buffer")
    flag = position.compliance(F.col("cet1_ratio_pct"), F.lit(MINIMUM_PCT), margin)
    return capital_position(spark, sf).select("reporting_date", "entity", flag.alias("compliance"))


def metric_simple_sum(spark, sf):
    return _doubles(capital_layer(spark, sf).query(["cet1_capital", "rwa"]), "cet1_capital", "rwa")


def metric_simple_avg(spark, sf):
    return _doubles(capital_layer(spark, sf).query(["cet1_ratio"]), cet1_ratio=6)


def metric_derived(spark, sf):
    wanted = ["buffer_headroom", "weighted_cet1_ratio"]
    out = capital_layer(spark, sf).query(wanted, group_by=["entity"])
    return _doubles(out, buffer_headroom=6)


def metric_by_month(spark, sf):
    out = capital_layer(spark, sf).query(["cet1_ratio", "buffer_headroom"], group_by=["metric_time__month"])
    return _doubles(out, cet1_ratio=6, buffer_headroom=6)


def metric_by_quarter(spark, sf):
    out = trading_layer(spark, sf).query(["ordered", "order_count"], group_by=["ordered__quarter", "status"])
    return _doubles(out, "ordered")


def metric_by_entity(spark, sf):
    out = capital_layer(spark, sf).query(["rwa"], group_by=["bank_entity__entity"])
    return _doubles(out, "rwa")


def metric_latest(spark, sf):
    out = capital_layer(spark, sf).query(["rwa_latest", "rwa"], group_by=["entity"])
    return _doubles(out, "rwa_latest", "rwa")


def metric_filtered(spark, sf):
    out = capital_layer(spark, sf).query(
        ["cet1_capital"], group_by=["entity"], where=["reporting_date >= '1999-01-01'", "cet1_ratio_pct > 30"]
    )
    return _doubles(out, "cet1_capital")


def multi_metric(spark, sf):
    out = capital_layer(spark, sf).query(
        ["cet1_capital", "rwa", "buffer_headroom"], group_by=["metric_time__year", "entity"]
    )
    return _doubles(out, "cet1_capital", "rwa", buffer_headroom=6)


def cross_model_metric(spark, sf):
    out = trading_layer(spark, sf).query(
        ["order_count", "ordered", "shipped", "shipped_share"], group_by=["metric_time__month"]
    )
    return _doubles(out, "ordered", "shipped")


def cross_model_total(spark, sf):
    return _doubles(trading_layer(spark, sf).query(["order_count", "shipped", "shipped_share"]), "shipped")


def metric_time_filled(spark, sf):
    spine = spine_over(read_table(spark, sf, "orders"), "o_orderdate")
    out = trading_layer(spark, sf).query(
        ["urgent"], group_by=["metric_time__day"], spine=spine
    )
    return _doubles(out, "urgent")


def metric_order_desc(spark, sf):
    out = capital_layer(spark, sf).query(
        ["rwa"], group_by=["entity", "metric_time__quarter"], order_by=["-rwa"], limit=7
    )
    return _doubles(out, "rwa")


def metric_catalogue(spark, sf):
    """Every metric as declared, beside its present value over the whole table."""
    layer = capital_layer(spark, sf)
    values = layer.query(list(layer.metrics))
    pairs = [
        F.struct(F.lit(n).alias("name"), F.round(F.col(n).cast("double"), 2).alias("value")) for n in layer.metrics
    ]
    listed = layer.catalogue(spark).select("name", "label", "type", F.size("dimensions").alias("n_dimensions"))
    return listed.join(values.select(F.inline(F.array(*pairs))), "name")


def validate_metrics(spark, sf):
    return capital_layer(spark, sf).validate(spark).select("kind", "name", "valid", "rows")


def entity_uniqueness(spark, sf):
    return entity_duplicates(capital_model(capital_position(spark, sf)), "bank_entity")


def ratio_of_sums(spark, sf):
    rows = capital_position(spark, sf, decimals=True)
    return position.ratio_of_sums(rows, "cet1_capital_mm", "rwa_mm", ["entity"]).select("entity", "ratio_of_sums")


def latest_row(spark, sf):
    rows = position.latest_row(capital_position(spark, sf), "reporting_date", ["entity"])
    return rows.withColumn("buffer_headroom", position.headroom("cet1_ratio_pct", "combined_buffer"))


def latest_per_entity(spark, sf):
    return position.latest_per(capital_position(spark, sf), ["entity"], "reporting_date")


def latest_order_per_customer(spark, sf):
    """The same over raw rows, where dates tie and the order number decides."""
    orders = read_table(spark, sf, "orders")
    return position.latest_per(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


def growth_since(spark, sf):
    known = capital_position(spark, sf).where(F.col("cet1_capital_mm").isNotNull())
    out = position.growth_since(known, ["entity"], "reporting_date", "cet1_capital_mm", BASE_DATE)
    return _doubles(out, growth=2, growth_pct=6)


def rwa_qoq(spark, sf):
    rows = capital_position(spark, sf).select("entity", "reporting_date", "rwa_mm")
    out = position.period_change(rows, ["entity"], "reporting_date", "rwa_mm", "rwa_change")
    return _doubles(out, rwa_change=2)


def ratio_trend(spark, sf):
    rows = capital_position(spark, sf, decimals=True)
    return _doubles(position.trend(rows, "reporting_date", "cet1_capital_mm", "rwa_mm", "cet1_ratio_pct"), average_ratio=6)


def ratio_mismatch(spark, sf):
    """Ratios kept with one decimal, as a report would, against recomputed ones."""
    stored = capital_position(spark, sf).withColumn("stored_pct", F.round("cet1_ratio_pct", 1))
    off = formula_mismatches(stored, "stored_pct", "cet1_capital_mm", "rwa_mm", 0.04)
    return off.select("reporting_date", "entity", "stored_pct", "recomputed")


QUERIES = {
    "model_capital_position": model_capital_position,
    "headroom": headroom,
    "ratio_pct": ratio_pct,
    "compliance_flag": compliance_flag,
    "metric_simple_sum": metric_simple_sum,
    "metric_simple_avg": metric_simple_avg,
    "metric_derived": metric_derived,
    "metric_by_month": metric_by_month,
    "metric_by_quarter": metric_by_quarter,
    "metric_by_entity": metric_by_entity,
    "metric_latest": metric_latest,
    "metric_filtered": metric_filtered,
    "multi_metric": multi_metric,
    "cross_model_metric": cross_model_metric,
    "cross_model_total": cross_model_total,
    "metric_time_filled": metric_time_filled,
    "metric_order_desc": metric_order_desc,
    "metric_catalogue": metric_catalogue,
    "validate_metrics": validate_metrics,
    "entity_uniqueness": entity_uniqueness,
    "ratio_of_sums": ratio_of_sums,
    "latest_row": latest_row,
    "latest_per_entity": latest_per_entity,
    "latest_order_per_customer": latest_order_per_customer,
    "growth_since": growth_since,
    "rwa_qoq": rwa_qoq,
    "ratio_trend": ratio_trend,
    "ratio_mismatch": ratio_mismatch,
}

_SUM = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
_CAPITAL, _RWA = _SUM.format("cet1_capital_mm"), _SUM.format("rwa_mm")

ORACLE = {
    "model_capital_position": f"{CAPITAL_SQL} SELECT * FROM capital_position",
    "headroom": f"""{CAPITAL_SQL}
        SELECT reporting_date, entity, cet1_ratio_pct - combined_buffer AS buffer_headroom FROM capital_position""",
    "ratio_pct": f"""{CAPITAL_SQL}
        SELECT reporting_date, entity, cet1_ratio_pct AS ratio_pct FROM capital_position""",
    "compliance_flag": f"""{CAPITAL_SQL}
        SELECT reporting_date, entity,
               CASE WHEN cet1_ratio_pct >= {MINIMUM_PCT} AND cet1_ratio_pct >= combined_buffer THEN 'compliant'
                    WHEN cet1_ratio_pct IS NOT NULL THEN 'breach' END AS compliance
        FROM capital_position""",
    "metric_simple_sum": f"{CAPITAL_SQL} SELECT {_CAPITAL} AS cet1_capital, {_RWA} AS rwa FROM capital_position",
    "metric_simple_avg": f"{CAPITAL_SQL} SELECT ROUND(AVG(cet1_ratio_pct), 6) AS cet1_ratio FROM capital_position",
    "metric_derived": f"""{CAPITAL_SQL}
        SELECT entity, ROUND(AVG(cet1_ratio_pct) - AVG(combined_buffer), 6) AS buffer_headroom,
               {_CAPITAL} / {_RWA} * 100 AS weighted_cet1_ratio
        FROM capital_position GROUP BY ALL""",
    "metric_by_month": f"""{CAPITAL_SQL}
        SELECT CAST(date_trunc('month', reporting_date) AS DATE) AS metric_time__month,
               ROUND(AVG(cet1_ratio_pct), 6) AS cet1_ratio,
               ROUND(AVG(cet1_ratio_pct) - AVG(combined_buffer), 6) AS buffer_headroom
        FROM capital_position GROUP BY ALL""",
    "metric_by_quarter": f"""
        SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS ordered__quarter, o_orderstatus AS status,
               {_SUM.format("o_totalprice")} AS ordered, COUNT(*) AS order_count
        FROM orders GROUP BY ALL""",
    "metric_by_entity": f"""{CAPITAL_SQL}
        SELECT entity AS bank_entity__entity, {_RWA} AS rwa FROM capital_position GROUP BY ALL""",
    "metric_latest": f"""{CAPITAL_SQL}
        SELECT entity, ARG_MAX(rwa_mm, reporting_date) AS rwa_latest, {_RWA} AS rwa
        FROM capital_position GROUP BY ALL""",
    "metric_filtered": f"""{CAPITAL_SQL}
        SELECT entity, {_CAPITAL} AS cet1_capital FROM capital_position
        WHERE reporting_date >= '1999-01-01' AND cet1_ratio_pct > 30 GROUP BY ALL""",
    "multi_metric": f"""{CAPITAL_SQL}
        SELECT CAST(date_trunc('year', reporting_date) AS DATE) AS metric_time__year, entity,
               {_CAPITAL} AS cet1_capital, {_RWA} AS rwa,
               ROUND(AVG(cet1_ratio_pct) - AVG(combined_buffer), 6) AS buffer_headroom
        FROM capital_position GROUP BY ALL""",
    "cross_model_metric": f"""
        WITH placed AS (
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, COUNT(*) AS order_count,
                   {_SUM.format("o_totalprice")} AS ordered FROM orders GROUP BY ALL),
        sent AS (
            SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, {_SUM.format("l_extendedprice")} AS shipped
            FROM lineitem GROUP BY ALL)
        SELECT COALESCE(placed.m, sent.m) AS metric_time__month, order_count, ordered, shipped,
               shipped / NULLIF(ordered, 0) AS shipped_share
        FROM placed FULL JOIN sent ON placed.m = sent.m""",
    "cross_model_total": f"""
        SELECT order_count, shipped, shipped / ordered AS shipped_share
        FROM (SELECT COUNT(*) AS order_count, {_SUM.format("o_totalprice")} AS ordered FROM orders),
             (SELECT {_SUM.format("l_extendedprice")} AS shipped FROM lineitem)""",
    "metric_time_filled": f"""
        WITH spine AS (
            SELECT CAST(UNNEST(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
            FROM orders),
        daily AS (
            SELECT CAST(o_orderdate AS DATE) AS d,
                   {_SUM.format("CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN o_totalprice END")} AS urgent
            FROM orders GROUP BY ALL)
        SELECT spine.d AS metric_time__day, urgent FROM spine LEFT JOIN daily ON spine.d = daily.d""",
    "metric_order_desc": f"""{CAPITAL_SQL}
        SELECT entity, CAST(date_trunc('quarter', reporting_date) AS DATE) AS metric_time__quarter, {_RWA} AS rwa
        FROM capital_position GROUP BY ALL ORDER BY rwa DESC NULLS LAST, 1, 2 LIMIT 7""",
    "metric_catalogue": f"""{CAPITAL_SQL},
        v AS (
            SELECT AVG(cet1_ratio_pct) AS ratio, AVG(combined_buffer) AS buffer, {_CAPITAL} AS capital, {_RWA} AS rwa,
                   SUM(CASE WHEN reporting_date = (SELECT MAX(reporting_date) FROM capital_position)
                       THEN rwa_mm END) AS newest
            FROM capital_position)
        SELECT 'cet1_ratio' AS name, 'CET1 Ratio (%)' AS label, 'simple' AS type, 6 AS n_dimensions,
               ROUND(ratio, 2) AS value FROM v
        UNION ALL SELECT 'combined_buffer_requirement', 'Combined Buffer Requirement (%)', 'simple', 6,
               ROUND(buffer, 2) FROM v
        UNION ALL SELECT 'cet1_capital', 'CET1 Capital (MM)', 'simple', 6, ROUND(capital, 2) FROM v
        UNION ALL SELECT 'rwa', 'Risk-Weighted Assets (MM)', 'simple', 6, ROUND(rwa, 2) FROM v
        UNION ALL SELECT 'rwa_latest', 'Newest Risk-Weighted Assets (MM)', 'simple', 6, ROUND(newest, 2) FROM v
        UNION ALL SELECT 'buffer_headroom', 'Buffer Headroom (pp)', 'derived', 6, ROUND(ratio - buffer, 2) FROM v
        UNION ALL SELECT 'weighted_cet1_ratio', 'Weighted CET1 Ratio (%)', 'derived', 6,
               ROUND(capital / rwa * 100, 2) FROM v""",
    "validate_metrics": f"""{CAPITAL_SQL},
        n AS (SELECT COUNT(cet1_capital_mm) AS capital, COUNT(rwa_mm) AS rwa, COUNT(cet1_ratio_pct) AS ratio,
                     COUNT(combined_buffer) AS buffer FROM capital_position)
        SELECT 'measure' AS kind, 'cet1_capital_total' AS name, TRUE AS valid, capital AS rows FROM n
        UNION ALL SELECT 'measure', 'rwa_total', TRUE, rwa FROM n
        UNION ALL SELECT 'measure', 'cet1_ratio_avg', TRUE, ratio FROM n
        UNION ALL SELECT 'measure', 'combined_buffer_avg', TRUE, buffer FROM n
        UNION ALL SELECT 'measure', 'rwa_newest', TRUE, rwa FROM n
        UNION ALL SELECT * FROM (VALUES
            ('dimension', 'reporting_date', TRUE, CAST(NULL AS BIGINT)), ('dimension', 'entity', TRUE, NULL),
            ('entity', 'bank_entity', TRUE, NULL), ('metric', 'cet1_ratio', TRUE, NULL),
            ('metric', 'combined_buffer_requirement', TRUE, NULL), ('metric', 'cet1_capital', TRUE, NULL),
            ('metric', 'rwa', TRUE, NULL), ('metric', 'rwa_latest', TRUE, NULL),
            ('metric', 'buffer_headroom', TRUE, NULL), ('metric', 'weighted_cet1_ratio', TRUE, NULL))""",
    "entity_uniqueness": f"""{CAPITAL_SQL}
        SELECT entity AS bank_entity, COUNT(*) AS rows FROM capital_position GROUP BY ALL HAVING COUNT(*) > 1""",
    "ratio_of_sums": f"""{CAPITAL_SQL}
        SELECT entity, {_CAPITAL} / {_RWA} * 100 AS ratio_of_sums FROM capital_position GROUP BY ALL""",
    "latest_row": f"""{CAPITAL_SQL}
        SELECT *, cet1_ratio_pct - combined_buffer AS buffer_headroom FROM capital_position
        ORDER BY reporting_date DESC, entity LIMIT 1""",
    "latest_per_entity": f"""{CAPITAL_SQL}
        SELECT * FROM capital_position QUALIFY ROW_NUMBER() OVER (PARTITION BY entity ORDER BY reporting_date DESC) = 1""",
    "latest_order_per_customer": """
        SELECT * FROM orders
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "growth_since": f"""{CAPITAL_SQL},
        ends AS (
            SELECT entity, ARG_MIN(cet1_capital_mm, reporting_date) AS first_value,
                   ARG_MAX(cet1_capital_mm, reporting_date) AS last_value
            FROM capital_position WHERE reporting_date >= DATE '{BASE_DATE}' AND cet1_capital_mm IS NOT NULL
            GROUP BY ALL)
        SELECT *, ROUND(last_value - first_value, 2) AS growth,
               ROUND((last_value - first_value) / NULLIF(first_value, 0) * 100, 6) AS growth_pct
        FROM ends""",
    "rwa_qoq": f"""{CAPITAL_SQL}
        SELECT entity, reporting_date, rwa_mm,
               ROUND(rwa_mm - LAG(rwa_mm) OVER (PARTITION BY entity ORDER BY reporting_date), 2) AS rwa_change
        FROM capital_position""",
    "ratio_trend": f"""{CAPITAL_SQL}
        SELECT reporting_date, ROUND(AVG(cet1_ratio_pct), 6) AS average_ratio,
               {_CAPITAL} / {_RWA} * 100 AS ratio_of_sums
        FROM capital_position GROUP BY ALL ORDER BY reporting_date""",
    "ratio_mismatch": f"""{CAPITAL_SQL}
        SELECT reporting_date, entity, ROUND(cet1_ratio_pct, 1) AS stored_pct, cet1_ratio_pct AS recomputed
        FROM capital_position WHERE ABS(ROUND(cet1_ratio_pct, 1) - cet1_ratio_pct) > 0.04""",
}
