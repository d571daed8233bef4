"""Every registered query against its SQL. On smaller tables no user has the ages asked for."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from oracle_check import connect, difference

import __spark_entry__ as registered

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


OWN = sorted(q.__name__ for q in registered._QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    problem, _ = difference(spark, con, SF, name)
    assert problem is None


def test_every_query_has_sql():
    assert set(OWN) <= set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() == 15
