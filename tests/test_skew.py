"""The same comparison where a third of all reports are copies of one row.

Tables are folders of several files here, nothing is broadcast by size, and the thresholds of
adaptive execution are small enough to split partitions of this size.
"""

from __future__ import annotations

import os

import pytest
from conftest import assert_same_result, duck_on

from riskloom.plans import catalog, oracle

QUERIES = catalog.QUERIES
SQL = oracle.statements()
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}

# Writing a file per day takes long and is compared on the plain tables.
SLOW = {"csv_ingest"}


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duck_on(sf_dir)
    for name in ("supplier", "nation", "customer", "orders", "events", "lineitem"):
        os.makedirs(f"{folder}/{name}.parquet")
        con.execute(f"COPY {name} TO '{folder}/{name}.parquet/a.parquet' (FORMAT parquet)")
    hot = "(SELECT * FROM {0} ORDER BY ALL LIMIT 1), range((SELECT COUNT(*) // {1} FROM {0}))"
    for part in range(4):
        copies = hot.format("lineitem", 8)
        con.execute(
            f"COPY (SELECT t.* EXCLUDE (range) FROM (SELECT * FROM {copies}) t) "
            f"TO '{folder}/lineitem.parquet/hot{part}.parquet' (FORMAT parquet)"
        )
    copies = hot.format("events", 2)
    con.execute(
        f"COPY (SELECT t.* EXCLUDE (range) FROM (SELECT * FROM {copies}) t) "
        f"TO '{folder}/events.parquet/hot.parquet' (FORMAT parquet)"
    )
    con.close()
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield folder
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def duck(skewed):
    con = duck_on(skewed)
    yield con
    con.close()


def test_a_third_of_the_reports_are_copies(duck):
    total, hot = duck.execute(
        "SELECT SUM(n), MAX(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY ALL)"
    ).fetchone()
    assert hot >= total / 3 - 4


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_query_matches_sql(spark, duck, skewed, name):
    assert_same_result(QUERIES[name](spark, skewed), duck, SQL[name])
