"""Every query against its SQL on the smallest tables (or those TEST_SF_DIR names)."""

from __future__ import annotations

import os
import pathlib
import subprocess
import sys

import pytest
from compare import connect, oracle_rows, spark_rows

import __spark_entry__ as driver

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for module in driver.OWN for name, query in module.QUERIES.items()}
ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected = oracle_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)
    assert set(QUERIES) | set(ORACLE) <= set(driver.queries())


def test_the_library_stands_without_the_training_data_operators():
    """The entry imports, and no query is lost, where their package and the pipeline are not there."""
    script = (
        "import sys\n"
        "for name in ('corpus_pipeline', 'tessera.llm'): sys.modules[name] = None\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()))"
    )
    root = os.path.dirname(os.path.abspath(driver.__file__))
    out = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(QUERIES))] * 2


def test_nothing_else_imports_the_training_data_operators():
    root = pathlib.Path(driver.__file__).parent / "tessera"
    for file in root.rglob("*.py"):
        if "llm" not in file.parts:
            assert "tessera.llm" not in file.read_text(encoding="utf-8")


def test_entry(spark):
    assert driver.entry(spark).count() == 3
