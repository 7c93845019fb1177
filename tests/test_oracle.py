"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import assert_same_result, duck_on

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from riskloom.plans import catalog, oracle  # noqa: E402

QUERIES = catalog.QUERIES
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duck_on(sf_dir)
    yield con
    con.close()


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert_same_result(QUERIES[name](spark, sf_dir), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10
    assert [r.high_risk_rows for r in rows] == sorted(
        [r.high_risk_rows for r in rows], reverse=True
    )
