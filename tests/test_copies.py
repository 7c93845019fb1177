from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.operators.copies import rows_beyond

SCHEMA = "a INT, b STRING"


def sample(seed, n):
    pick = random.Random(seed).choice
    return [(pick([1, 2, 3, None]), pick(["x", "y", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("step", [1, 3, 1000])
def test_equals_the_difference_of_counters(spark, seed, step):
    left, right = sample(seed, 80), sample(seed + 100, 50)
    df, other = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = Counter(tuple(r) for r in rows_beyond(df, other, step).collect())
    assert got == Counter(left) - Counter(right)


def test_nothing_stored_and_nothing_owed(spark):
    df = spark.createDataFrame(sample(1, 30), SCHEMA)
    assert rows_beyond(df, df.limit(0)).count() == 30
    assert rows_beyond(df, df.union(df)).isEmpty()


def test_copies_of_one_row_come_from_several_tasks(spark):
    df = spark.range(100_000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    result = rows_beyond(df, df.limit(7), step=1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = result.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in tasks) == 99_993
    assert len(tasks) > 1
