"""Trade exposure: orders as trades, their customers as counterparties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numbers import decimals_as_doubles, exact_parts, exact_sum, exact_sum_of
from tessera.operators.exposure import concentration, due_this_week, due_within, exposure_by, rated_at_or_below
from tessera.operators.semantic import SemanticQuery, run
from tessera.plans.tables import orders, read_table
from tessera.session import new_path
from tessera.sources.catalog import conform, save_model
from tessera.sources.schemas import TRADE_EXPOSURE

AS_OF = "1998-01-01"
SCALE = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FLOOR = "HOUSEHOLD"
OPEN = "status = 'O'"


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Single trades with the rating of their counterparty.

    Here rows, not sums, meet the customers. Only the columns named are read; a customer with
    very many trades is left to the adaptive skew join, which splits its partition.
    """
    placed = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("trade_id"),
        F.col("o_custkey"),
        F.col("o_totalprice").alias("notional"),
        F.col("o_orderdate").alias("settles"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("instrument"),
    )
    parties = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("counterparty"),
        F.col("c_mktsegment").alias("rating"),
        "c_nationkey",
    )
    return placed.join(parties, "o_custkey", "left").drop("o_custkey")


def model_trade_exposure(spark, sf):
    """The trades as a typed table, written and read back."""
    regions = read_table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nations = read_table(spark, sf, "nation").join(regions, "n_regionkey", "left")
    homes = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("home"))
    state = F.when(F.col("status") == "O", "OPEN").when(F.col("status") == "F", "SETTLED").otherwise("DEFAULTED")
    wide = trades(spark, sf).join(homes, "c_nationkey", "left").select(
        F.col("trade_id"),
        "counterparty",
        F.col("instrument").alias("instrument_type"),
        F.col("notional").alias("notional_usd_mm"),
        F.col("settles").alias("settlement_date"),
        F.col("rating").alias("credit_rating"),
        F.col("home").alias("region"),
        state.alias("status"),
    )
    saved = save_model(conform(wide, TRADE_EXPOSURE), new_path(spark, "trade-exposure"))
    return saved.withColumn("notional_usd_mm", F.col("notional_usd_mm").cast("double"))


def _open_by(spark: SparkSession, sf: str, *dimensions: str, filters: tuple[str, ...] = (), decimals: bool = False) -> DataFrame:
    query = SemanticQuery.of(
        measures=[{"formula": "order_total:sum", "name": "exposure"}, {"formula": "*:count", "name": "trades"}],
        dimensions=dimensions,
        filters=[OPEN, *filters],
    )
    return run(orders(spark, sf), query, decimals)


def open_exposure_by_counterparty(spark, sf):
    return _open_by(spark, sf, "customer_id", "customer.c_name").orderBy(F.col("exposure").desc(), "customer_id")


def exposure_by_region(spark, sf):
    return _open_by(spark, sf, "customer.nation.region.r_name")


def exposure_by_instrument(spark, sf):
    instruments = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    return exposure_by(instruments, ["o_orderpriority"], "o_totalprice")


def rating_concentration(spark, sf):
    rated = _open_by(spark, sf, "customer.c_mktsegment", decimals=True).withColumnRenamed("customer_c_mktsegment", "rating")
    return decimals_as_doubles(concentration(rated, ["rating"], F.col("exposure")))


def exposure_rated_at_or_below(spark, sf):
    """Which counterparties stand at the rating or worse, and the open exposure to each."""
    low = ", ".join(f"'{r}'" for r in SCALE[SCALE.index(FLOOR) :])
    rated = _open_by(
        spark, sf, "customer_id", "customer.c_name", "customer.c_mktsegment", filters=(f"customer.c_mktsegment IN ({low})",)
    )
    return rated.withColumnsRenamed({"customer_c_name": "counterparty", "customer_c_mktsegment": "rating"})


def settles_this_week(spark, sf):
    """Open trades that settle between the day of the report and the end of its week."""
    due = trades(spark, sf).where((F.col("status") == "O") & due_this_week(F.col("settles"), AS_OF))
    return due.select("trade_id", "counterparty", F.col("settles").cast("date").alias("settles"), "notional")


def charged_exact(spark, sf):
    """Charges of more than two decimals, summed without loss and rounded at a stated place."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = read_table(spark, sf, "lineitem").select("l_returnflag", charge.alias("charge"))
    sums = lines.groupBy("l_returnflag").agg(exact_sum("charge").alias("charged"), F.count(F.lit(1)).alias("items"))
    return sums.withColumn("charged", F.round("charged", 3))


def due_within_n_days(spark, sf):
    open_trades = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    due = open_trades.where(due_within(F.col("o_orderdate"), AS_OF, 30))
    return due.select("o_orderkey", F.col("o_orderdate").cast("date").alias("settles"), "o_totalprice")


def settlement_ladder(spark, sf):
    """Open amount and trades due within growing horizons, in one pass; overdue trades apart."""
    open_trades = read_table(spark, sf, "orders").where(F.col("o_orderstatus") == "O")
    when = F.col("o_orderdate")
    rungs = [("overdue", when < F.lit(AS_OF).cast("date"))]
    rungs += [(f"within {n} days", due_within(when, AS_OF, n, overdue=False)) for n in (7, 30, 90)]
    # Parts and conditions are worked out once for each trade, then only summed.
    parts = exact_parts("o_totalprice")
    open_trades = open_trades.select(*[c.alias(n) for n, c in parts.items()], *[due.alias(f"due {n}") for n, due in rungs])
    held = {n: F.col(n) for n in parts}
    row = open_trades.agg(
        *[exact_sum_of(held, when=F.col(f"due {name}")).alias(f"sum {name}") for name, _ in rungs],
        *[F.count_if(F.col(f"due {name}")).alias(f"n {name}") for name, _ in rungs],
    )
    pairs = [
        F.struct(F.lit(n).alias("horizon"), F.col(f"sum {n}").alias("exposure"), F.col(f"n {n}").alias("trades"))
        for n, _ in rungs
    ]
    return row.select(F.inline(F.array(*pairs)))


def rating_at_or_below(spark, sf):
    open_trades = trades(spark, sf).where(F.col("status") == "O")
    low = open_trades.where(rated_at_or_below(F.col("rating"), FLOOR, SCALE))
    return low.drop("settles", "instrument", "c_nationkey")


def exposure_cuts(spark, sf):
    """Open exposure by region, by instrument and in all, from one reading and one aggregate."""
    asked = SemanticQuery.of(
        ["order_total:sum", "*:count"], ["customer.nation.region.r_name", "priority"], [OPEN],
        sets=[["customer.nation.region.r_name"], ["priority"], []],
    )
    out = decimals_as_doubles(run(orders(spark, sf), asked))
    return out.withColumnsRenamed({"customer_nation_region_r_name": "region", "priority": "instrument", "order_total_sum": "exposure", "count": "trades"})


QUERIES = {
    "exposure_cuts": exposure_cuts,
    "model_trade_exposure": model_trade_exposure,
    "open_exposure_by_counterparty": open_exposure_by_counterparty,
    "exposure_by_region": exposure_by_region,
    "exposure_by_instrument": exposure_by_instrument,
    "rating_concentration": rating_concentration,
    "due_within_n_days": due_within_n_days,
    "settlement_ladder": settlement_ladder,
    "rating_at_or_below": rating_at_or_below,
    "exposure_rated_at_or_below": exposure_rated_at_or_below,
    "settles_this_week": settles_this_week,
    "charged_exact": charged_exact,
}

_SUM = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"
_PARTY = "FROM orders LEFT JOIN customer ON o_custkey = c_custkey"

ORACLE = {
    "exposure_cuts": f"""
        SELECT r_name AS region, o_orderpriority AS instrument, GROUPING(r_name, o_orderpriority) AS grouping_id,
               {_SUM} AS exposure, COUNT(*) AS trades
        {_PARTY} LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE o_orderstatus = 'O' GROUP BY GROUPING SETS ((r_name), (o_orderpriority), ())""",
    "model_trade_exposure": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS trade_id, c_name AS counterparty, o_orderpriority AS instrument_type,
               o_totalprice AS notional_usd_mm, CAST(o_orderdate AS DATE) AS settlement_date,
               c_mktsegment AS credit_rating, r_name AS region,
               CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'SETTLED' ELSE 'DEFAULTED' END AS status
        {_PARTY} LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "open_exposure_by_counterparty": f"""
        SELECT o_custkey AS customer_id, c_name AS customer_c_name, {_SUM} AS exposure, COUNT(*) AS trades
        {_PARTY} WHERE o_orderstatus = 'O' GROUP BY ALL""",
    "exposure_by_region": f"""
        SELECT r_name AS customer_nation_region_r_name, {_SUM} AS exposure, COUNT(*) AS trades
        {_PARTY} LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE o_orderstatus = 'O' GROUP BY ALL""",
    "exposure_by_instrument": f"""
        SELECT o_orderpriority, {_SUM} AS exposure, COUNT(*) AS trades
        FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL""",
    "rating_concentration": f"""
        WITH rated AS (
            SELECT c_mktsegment AS rating, {_SUM} AS exposure {_PARTY} WHERE o_orderstatus = 'O' GROUP BY ALL)
        SELECT rating, exposure,
               exposure / (SELECT {_SUM} FROM orders WHERE o_orderstatus = 'O') * 100 AS share_pct
        FROM rated""",
    "due_within_n_days": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS settles, o_totalprice FROM orders
        WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' + INTERVAL 30 DAY""",
    "settlement_ladder": f"""
        WITH due AS (
            SELECT date_diff('day', DATE '{AS_OF}', CAST(o_orderdate AS DATE)) AS days, o_totalprice
            FROM orders WHERE o_orderstatus = 'O')
        SELECT 'overdue' AS horizon, {_SUM} AS exposure, COUNT(*) AS trades FROM due WHERE days < 0
        UNION ALL SELECT 'within 7 days', {_SUM}, COUNT(*) FROM due WHERE days BETWEEN 0 AND 7
        UNION ALL SELECT 'within 30 days', {_SUM}, COUNT(*) FROM due WHERE days BETWEEN 0 AND 30
        UNION ALL SELECT 'within 90 days', {_SUM}, COUNT(*) FROM due WHERE days BETWEEN 0 AND 90""",
    "rating_at_or_below": f"""
        SELECT o_orderkey AS trade_id, o_totalprice AS notional, o_orderstatus AS status, c_name AS counterparty,
               c_mktsegment AS rating
        {_PARTY} WHERE o_orderstatus = 'O' AND c_mktsegment >= '{FLOOR}'""",
    "exposure_rated_at_or_below": f"""
        SELECT o_custkey AS customer_id, c_name AS counterparty, c_mktsegment AS rating, {_SUM} AS exposure, COUNT(*) AS trades
        {_PARTY} WHERE o_orderstatus = 'O' AND c_mktsegment >= '{FLOOR}' GROUP BY ALL""",
    "settles_this_week": f"""
        SELECT o_orderkey AS trade_id, c_name AS counterparty, CAST(o_orderdate AS DATE) AS settles, o_totalprice AS notional
        {_PARTY} WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) >= DATE '{AS_OF}'
          AND CAST(o_orderdate AS DATE) < CAST(date_trunc('week', DATE '{AS_OF}') AS DATE) + 7""",
    "charged_exact": """
        SELECT l_returnflag, round(fsum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 3) AS charged, COUNT(*) AS items
        FROM lineitem GROUP BY ALL""",
}
