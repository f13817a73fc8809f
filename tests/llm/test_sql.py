"""Queries of the training-data operators against their SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, oracle_rows, spark_rows

from tessera.llm.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows(spark, con, name):
    assert spark_rows(QUERIES[name](spark, FOLDER)) == oracle_rows(con, ORACLE[name])


def test_thirteen_queries():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
