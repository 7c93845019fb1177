"""The registered queries: against SQL where there is some, else that they cover the table."""

from __future__ import annotations

import pytest
from conftest import assert_same_result, duck_on

from riskloom.llm.oracle import STATEMENTS
from riskloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duck_on(sf_dir)
    yield con
    con.close()


def test_one_query_per_operator():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert len(QUERIES) == 13
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert_same_result(QUERIES[name](spark, sf_dir), duck, STATEMENTS[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_query_covers_its_table(spark, duck, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).select("doc_id").distinct().count()
    assert rows == duck.execute("SELECT count(DISTINCT doc_id) FROM documents").fetchone()[0]
