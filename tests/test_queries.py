"""Every registered warehouse query against its SQL on the smallest data."""

from __future__ import annotations

import pytest

from __spark_entry__ import _warehouse_queries as queries
from __spark_entry__ import entry
from oracles import ORACLES
from tests.compare import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(con, df, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).count() == 6


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())
