"""Tables stored by their join key meet without a shuffle; hot keys are left to Spark's skew join."""

from __future__ import annotations

import uuid

import pytest
from compare import connect, oracle_rows, plan_of, spark_rows
from pyspark.sql import functions as F

from tessera.plans import retail
from tessera.session import new_path
from tessera.sources import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def merged(spark):
    """Sides of this size would be broadcast otherwise."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def store(spark, left, right, buckets=8):
    names = [f"{side}_{uuid.uuid4().hex}" for side in "ab"]
    out = catalog.save_colocated({names[0]: (left, ["k"]), names[1]: (right, ["j"])}, buckets, new_path(spark, "colocated"))
    return names, out[names[0]], out[names[1]]


def drop(spark, names):
    for name in names:
        spark.sql(f"DROP TABLE `{name}`")


def rows(spark, hot=False):
    key = F.when(F.lit(hot) & (F.col("id") % 3 == 0), 7).otherwise(F.when(F.col("id") % 50 != 0, F.col("id") % 90))
    left = spark.range(3000).select(key.cast("long").alias("k"), "id")
    return left, spark.range(80).select(F.col("id").alias("j"), (F.col("id") % 4).alias("kind"))


def test_a_join_of_stored_tables_has_no_exchange(spark, merged):
    left, right = rows(spark)
    names, a, b = store(spark, left, right)
    joined = a.join(b, F.col("k") == F.col("j"), "left")
    assert "Exchange" not in plan_of(joined)
    assert "Exchange" not in plan_of(a.groupBy("k").count())
    assert "Exchange" in plan_of(left.join(right, F.col("k") == F.col("j"), "left"))
    want = left.join(right, F.col("k") == F.col("j"), "left")
    assert spark_rows(joined) == spark_rows(want)
    drop(spark, names)


def test_each_bucket_is_one_file(spark):
    names, a, _ = store(spark, *rows(spark))
    assert len(a.inputFiles()) <= 8
    drop(spark, names)


def test_the_query_shuffles_groups_only(spark, merged):
    found = retail.revenue_colocated(spark, FOLDER)
    assert plan_of(found).count("Exchange hashpartitioning") == 1  # the answer's own groups
    con = connect(FOLDER)
    assert spark_rows(found) == oracle_rows(con, retail.ORACLE["revenue_colocated"])


def test_a_hot_key_is_not_put_into_one_bucket(spark, merged, monkeypatch):
    monkeypatch.setattr(catalog, "SMALL_BUCKET", 100)
    left, right = rows(spark, hot=True)
    names, a, b = store(spark, left, right, buckets=64)
    joined = a.join(b, F.col("k") == F.col("j"), "left")
    assert "Exchange" in plan_of(joined)  # both sides are shuffled, which Spark's skew join can split
    assert spark_rows(joined) == spark_rows(left.join(right, F.col("k") == F.col("j"), "left"))
    drop(spark, names)


def test_keys_that_are_null_and_empty_tables(spark, merged):
    left, right = rows(spark)
    nulls = left.withColumn("k", F.lit(None).cast("long"))
    for rows_left in (nulls, left.limit(0)):
        names, a, b = store(spark, rows_left, right)
        assert a.join(b, F.col("k") == F.col("j"), "left").count() == rows_left.count()
        drop(spark, names)


def test_what_cannot_be_stored_is_refused_and_leaves_nothing(spark):
    left, right = rows(spark)
    folder = new_path(spark, "colocated")
    with pytest.raises(ValueError, match="same types"):
        catalog.save_colocated({"x": (left, ["k"]), "y": (right.withColumn("j", F.col("j").cast("int")), ["j"])}, 4, folder)
    with pytest.raises(ValueError, match="same types"):
        catalog.save_colocated({}, 4, folder)
    names, _, _ = store(spark, left, right)
    with pytest.raises(ValueError, match="has a table"):
        catalog.save_colocated({names[0]: (left, ["k"])}, 4, folder)
    broken = right.withColumn("bad", F.raise_error(F.lit("no")).cast("int"))
    fresh = [f"c_{uuid.uuid4().hex}", f"d_{uuid.uuid4().hex}"]
    with pytest.raises(Exception, match="no"):
        catalog.save_colocated({fresh[0]: (left, ["k"]), fresh[1]: (broken, ["j"])}, 4, folder)
    assert not any(spark.catalog.tableExists(name) for name in fresh)
    drop(spark, names)
