"""Every registered document query on the smallest data, against its SQL where there is one."""

from __future__ import annotations

import pytest

import corpus_pipeline
from shelfwise.llm import oracles, queries
from tests.compare import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, con, name):
    df = queries.queries()[name](spark, FOLDER)
    if name in oracles.oracle_sql():
        assert compare(con, df, oracles.oracle_sql()[name]) is None
    else:
        table = {"op7_html_extraction": "pages", "op13_conversation_repair": None}.get(name, "documents")
        rows = df.count()
        assert rows > 0
        if table and name not in ("op3_packing", "op9_license_scans", "op12_spelling_variants"):
            assert rows == queries.table(spark, FOLDER, table).count()


def test_pipeline(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracles.oracle_sql()) <= set(queries.queries())
