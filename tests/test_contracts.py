"""The three contract dialects, and read-only SQL."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from tessera.sources import contracts as c
from tessera.sources.catalog import governed_sql, refresh_model, save_model
from tessera.sources.records import as_records

ORDERS = "/root/testdata/sf0.001/orders.parquet"

STANDARD = """
dataContractSpecification: 0.9.3
id: urn:x
info: {title: T, version: "1", status: active, owner: Team, contact: {email: a@b.c}}
terms: {usage: "  Use
  it. "}
models:
  pos:
    fields:
      d: {type: date, required: true, description: " Day "}
      n: {type: number}
quality:
  specification:
    checks for pos: [row_count > 0, max(n) < 25]
servicelevels:
  freshness: {description: Soon, threshold: P5D, timestampField: pos.d}
  retention: {period: P3Y}
"""


def test_yaml_contract(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "c.yaml"
    path.write_text(STANDARD)
    contract = c.load(path)
    assert contract.owner == "Team" and contract.contact == "a@b.c" and contract.usage == "Use it."
    assert contract.columns("pos") == (c.ColumnSpec("d", "date", "Day", True), c.ColumnSpec("n", "number"))
    assert contract.checks == {"pos": ("row_count > 0", "max(n) < 25")}
    assert contract.promise("freshness") == c.Promise("freshness", "P5D", "Soon", "d")
    assert contract.promise("retention").value == "P3Y" and contract.promise("uptime") is None
    assert contract.limitations == c.MISSING


def test_product_contract(spark):
    product = c.read(
        {
            "openDataProductSpecification": "2.0.0",
            "product": {
                "name": "P",
                "owner": {"name": "O", "email": "o@x"},
                "outputPorts": [{"tables": [{"name": "t", "columns": [{"name": "a", "type": "DATE"}]}]}],
                "slaProperties": [{"dimension": "freshness", "value": "T+1"}],
                "dataQuality": [{"checks": ["row_count > 0"]}, {"checks": ["min(a) > 0"]}],
                "terms": {"dataRetention": "P3Y"},
                "inputPorts": [{"name": "core"}],
            },
        }
    )
    assert product.checks == {"t": ("row_count > 0", "min(a) > 0")} and product.lineage == ("core",)
    assert [p.kind for p in product.promises] == ["freshness", "retention"]
    assert c.check_table(spark, [product]).count() == 2
    assert c.promise_table(spark, [product]).where("kind = 'freshness'").first().value == "T+1"
    assert c.contract_table(spark, [product]).first().owner == "O"
    assert dict(c.governance_facts(product))["term dataRetention"] == "P3Y"


def test_short_contract():
    short = c.read(
        {
            "name": "x",
            "owner": "me",
            "tables": [{"name": "t", "columns": [{"name": "a", "type": "DECIMAL(6,4)"}]}],
            "lineage": {"source_systems": [{"name": "s"}], "source_scripts": ["f"], "refresh_cadence": "quarterly"},
        }
    )
    assert short.lineage == ("s", "f") and short.promise("refresh").value == "quarterly"
    with pytest.raises(ValueError, match="dialect"):
        c.read({"something": 1})


@pytest.mark.parametrize(
    "text",
    [
        "DROP TABLE orders",
        "CREATE TABLE x AS SELECT 1",
        "INSERT INTO orders VALUES (1)",
        "SELECT 1) AS a; DROP VIEW orders --",
        "SET spark.x=1",
        "EXPLAIN SELECT 1",
    ],
)
def test_commands_are_refused(spark, text):
    with pytest.raises(ParseException):
        governed_sql(spark, {"orders": ORDERS}, text)


def test_only_named_tables_can_be_read(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("other_view")
    for text in ("SELECT * FROM other_view", f"SELECT * FROM parquet.`{ORDERS}`"):
        with pytest.raises(PermissionError):
            governed_sql(spark, {"orders": ORDERS}, text)
    spark.range(1).write.parquet(str(tmp_path / "stored"))
    spark.sql(f"CREATE TABLE stored_orders USING parquet LOCATION '{tmp_path}/stored'")
    nested = "SELECT * FROM orders WHERE 1 IN (SELECT id FROM default.stored_orders)"
    try:
        for text in ("SELECT * FROM stored_orders", nested):
            with pytest.raises(PermissionError, match="stored_orders"):
                governed_sql(spark, {"orders": ORDERS}, text)
    finally:
        spark.sql("DROP TABLE stored_orders")
    with pytest.raises(PermissionError):
        governed_sql(spark, {"orders": ORDERS}, "SELECT TRANSFORM(o_orderkey) USING 'cat' FROM orders")


@pytest.mark.parametrize(
    "text",
    [
        "SELECT java_method('java.util.UUID', 'randomUUID')",
        "SELECT reflect('java.lang.System', 'getenv')",
        "SELECT 1 FROM orders WHERE o_orderkey = length(try_reflect('java.util.UUID', 'randomUUID'))",
        "SELECT * FROM global_temp.other_view",
        "SELECT * FROM range(5)",
        "SELECT * FROM orders, LATERAL (SELECT reflect('java.lang.System', 'getenv'))",
        "WITH a AS (SELECT java_method('java.util.UUID', 'randomUUID') AS x) SELECT * FROM a",
        "SELECT (SELECT max(id) FROM somewhere.else) FROM orders",
        "SELECT input_file_name() FROM orders",
        "SELECT current_user()",
        "SELECT no_such_function(1)",
        "WITH a AS (SELECT 1 AS x) SELECT * FROM b",
        "SELECT x FROM orders LATERAL VIEW java_method('java.util.UUID', 'randomUUID') t AS x",
        "SELECT IDENTIFIER('java_method')('java.util.UUID', 'randomUUID') FROM orders",
        "SELECT IDENTIFIER('java_' || 'method')('java.lang.System', 'getProperty', 'user.dir') FROM orders",
        "SELECT IDENTIFIER('o_orderkey') FROM orders",
        "SELECT * FROM IDENTIFIER('orders')",
        "SELECT 1 FROM orders ORDER BY IDENTIFIER('reflect')('java.lang.System', 'getenv')",
        "SELECT transform(array(1), x -> IDENTIFIER('reflect')('java.lang.System', 'getenv')) FROM orders",
        "SELECT 1 FROM orders WHERE EXISTS (SELECT IDENTIFIER('uuid')())",
        "SELECT :p FROM orders",
    ],
)
def test_what_is_not_a_query_over_the_tables_is_refused(spark, text):
    spark.range(3).createOrReplaceGlobalTempView("other_view")
    with pytest.raises(PermissionError):
        governed_sql(spark, {"orders": ORDERS}, text)


@pytest.mark.parametrize(
    "text",
    [
        "SELECT map('a', a.o_orderkey) AS m FROM orders a JOIN orders b USING (o_orderkey)",
        "SELECT 'SubqueryAlias a.b' AS x, 'TRANSFORM map USING' AS y FROM orders",
        "WITH a AS (SELECT o_custkey FROM orders), b AS (SELECT * FROM a) SELECT count(DISTINCT o_custkey) AS n FROM b",
        "SELECT o_orderstatus, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS s FROM orders",
        "SELECT upper(o_orderstatus), CASE WHEN o_totalprice > 5 THEN 1 END, CAST(o_orderdate AS date) FROM ORDERS ORDER BY 1 LIMIT 3",
        "SELECT x FROM orders LATERAL VIEW explode(array(1, 2)) t AS x",
        "SELECT 1 UNION ALL SELECT count(*) FROM orders HAVING count(*) > 1",
        "SELECT * FROM (VALUES (1, 'a')) AS v(k, l) WHERE k IN (SELECT o_orderkey FROM orders) AND EXISTS (SELECT 1 FROM orders)",
        "SELECT o_custkey, transform(array(1, 2), x -> x + 1) FROM orders TABLESAMPLE (10 ROWS)",
        "SELECT o_orderkey FROM orders a WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders b WHERE b.o_custkey = a.o_custkey)",
        "SELECT avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) FROM orders",
        "SELECT rank() OVER w FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS LAST)",
        "SELECT o_orderstatus, o_orderpriority, count(*) FILTER (WHERE o_totalprice > 1) FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
        "SELECT count(*), grouping(o_orderstatus) FROM orders GROUP BY GROUPING SETS ((o_orderstatus), ())",
        "SELECT aggregate(array(1, 2), 0, (a, x) -> a + x, a -> a * 2), -o_custkey, o_custkey % 3, o_custkey DIV 2, 'a' || 'b' FROM orders",
        "SELECT * FROM orders WHERE o_orderstatus LIKE 'O%' AND o_orderpriority RLIKE '^1' AND o_custkey NOT BETWEEN 3 AND 5 OR o_orderdate IS NULL",
        "SELECT EXTRACT(year FROM o_orderdate), DATE '2024-01-01' - INTERVAL 1 MONTH, current_date(), struct(1 AS a).a, array(1)[0] FROM orders",
        "SELECT trim(BOTH 'x' FROM o_orderstatus), substring(o_orderstatus FROM 1 FOR 1), position('a' IN o_orderstatus), * EXCEPT (o_orderkey) FROM orders",
        "SELECT if(o_custkey > 3 AND NOT (o_custkey IN (1, 2)), 1, NULL) AS c, nullif(1, 2), coalesce(NULL, 2), first(o_custkey) OVER () FROM orders",
    ],
)
def test_queries_over_the_tables_run(spark, text):
    governed_sql(spark, {"orders": ORDERS}, text).limit(1).collect()


def test_queries_run(spark):
    text = "WITH o AS (SELECT * FROM orders) SELECT count(*) AS n FROM o -- all;"
    assert governed_sql(spark, {"orders": ORDERS}, text).first().n == 1500
    assert governed_sql(spark, {"orders": ORDERS}, "SELECT 1 AS a;").first().a == 1
    joined = "SELECT a.o_custkey, max(b.o_totalprice) AS m FROM orders a JOIN orders AS b USING (o_orderkey) GROUP BY 1"
    assert governed_sql(spark, {"orders": ORDERS}, joined).columns == ["o_custkey", "m"]


def test_records(spark, capital):
    rows = [r.value for r in as_records(capital.withColumn("x", F.lit(None).cast("int"))).collect()]
    assert rows[0] == (
        '{"reporting_date":"2025-09-30","entity":"BANK_HOLDCO","cet1_capital_mm":"27410.00","rwa_mm":"190500.00",'
        '"cet1_ratio_pct":"14.3900","combined_buffer":"9.7500","x":null}'
    )


def test_save_model_replaces(spark, tmp_path, capital):
    path = str(tmp_path / "m")
    save_model(capital, path)
    assert save_model(capital.limit(1), path).count() == 1
    assert save_model(capital, str(tmp_path / "p"), ["entity"]).count() == 3


def test_a_failed_write_leaves_the_old_model(spark, tmp_path, capital):
    path = str(tmp_path / "m")
    save_model(capital, path)
    with pytest.raises(Exception, match="boom"):
        save_model(capital.withColumn("entity", F.raise_error(F.lit("boom")).cast("string")), path)
    kept = spark.read.parquet(path)
    assert kept.count() == 3 and os.listdir(tmp_path) == ["m"]
    assert save_model(kept.limit(2), path).count() == 2  # made from what it replaces


def test_refresh_rewrites_the_changed_partitions_only(spark, tmp_path):
    path = str(tmp_path / "m")
    kind = "v int, day date"
    day = lambda k: dt.date(2024, 1, k)
    rows = [(k, day(1 + k % 4)) for k in range(40)] + [(99, None)]
    save_model(spark.createDataFrame(rows, kind), path, ["day"])
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    before = files()
    # A late row for the second, none left for the third, and a row without a day; the first is in the frame but not asked for.
    late = [(1000, day(2)), (1, day(2)), (7, day(1)), (98, None)]
    got = refresh_model(spark.createDataFrame(late, kind), path, "day", [day(2), day(3), None])
    want = [r for r in rows if r[1] in (day(1), day(4))] + [late[0], late[1], late[3]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    after = files()
    same = {f for f in before if "day=2024-01-01" in f or "day=2024-01-04" in f}
    assert same and all(after[f] == before[f] for f in same) and not set(after) & (set(before) - same)
    with pytest.raises(Exception, match="boom"):
        bad = spark.createDataFrame(late, kind).withColumn("v", F.when(F.col("v") == 1, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("v")))
        refresh_model(bad, path, "day", [day(2)])
    assert files() == after
    assert refresh_model(spark.createDataFrame([], kind), path, "day", []).count() == len(want)
