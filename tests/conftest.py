"""Shared session and tables. Helpers to import live in other modules: a second ``conftest`` may hide this one."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rows import CAPITAL_DDL, CAPITAL_ROWS, TRADE_DDL, TRADE_ROWS, capital_rows, trade_rows  # noqa: E402

from tessera.session import local_session, scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    with scratch(session):  # what the queries wrote goes when the tests end
        yield session


@pytest.fixture(scope="session")
def capital(spark):
    return spark.createDataFrame(capital_rows(CAPITAL_ROWS), CAPITAL_DDL)


@pytest.fixture(scope="session")
def trades(spark):
    return spark.createDataFrame(trade_rows(TRADE_ROWS), TRADE_DDL)
