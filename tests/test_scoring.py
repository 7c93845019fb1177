from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.constants import RISK_LABELS, US_STATE_CODES
from riskloom.functions.risk import category_label, code_of_label, risk_category
from riskloom.operators.lookups import conflicting_codes, lookup_join, with_state_code
from riskloom.operators.scoring import bucketizer, with_labels, with_risk_category, with_risk_score

EDGES = [
    (-5, 0), (-1, 0), (0, 1), (999, 1), (1000, 2), (9999, 2),
    (10000, 3), (99999, 3), (100000, 4), (10**12, 4), (None, None),
]


def test_bucket_edges(spark):
    df = spark.createDataFrame(EDGES, "risk_score LONG, expected INT")
    rows = df.withColumn("got", risk_category(F.col("risk_score"))).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


def test_expression_agrees_with_ml_stage(spark):
    scores = [(s,) for s, c in EDGES if c is not None]
    df = spark.createDataFrame(scores, "risk_score LONG")
    rows = bucketizer().transform(df).withColumn("e", risk_category(F.col("risk_score"))).collect()
    assert all(int(r.risk_category) == r.e for r in rows)


def test_score_is_a_long_and_null_if_a_count_is(spark):
    df = spark.createDataFrame(
        [(1, 300_000_000), (2, None), (None, 3)], "cases INT, deaths INT"
    )
    rows = df.transform(with_risk_score).transform(with_risk_category).collect()
    assert [(r.risk_score, r.risk_category) for r in rows] == [
        (3_000_000_001, 4), (None, None), (None, None)
    ]


def test_labels(spark):
    df = spark.createDataFrame([(c,) for c in [0, 1, 2, 3, 4, 5, -1, None]], "risk_category INT")
    got = [r.risk_category_text for r in df.transform(with_labels).collect()]
    assert got == [*RISK_LABELS.values(), None, None, None]
    assert [code_of_label(t) for t in RISK_LABELS.values()] == list(RISK_LABELS)
    assert code_of_label("Unknown") is None


def test_labels_of_double_codes(spark):
    df = spark.createDataFrame([(3.0,)], "code DOUBLE")
    assert df.select(category_label(F.col("code"))).first()[0] == "High"


def test_states_of_the_country(spark):
    assert len(US_STATE_CODES) == len(set(US_STATE_CODES.values())) == 50
    df = spark.createDataFrame([("Texas",), ("Guam",), (None,)], "state STRING")
    got = {r.state: r.state_code for r in with_state_code(df).collect()}
    assert got == {"Texas": "TX", "Guam": None, None: None}


def test_repeated_state_in_the_codes_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "state STRING")
    codes = spark.createDataFrame(
        [("A", "a1"), ("A", "a0"), (None, "x")], "state STRING, state_code STRING"
    )
    got = sorted((r.state, r.state_code) for r in with_state_code(df, codes).collect() if r.state == "A")
    assert got == [("A", "a0"), ("A", "a0")]


def test_lookup_gives_the_same_rows_broadcast_or_shuffled(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("state")
    )
    dim = spark.range(0, 500).select(
        F.col("id").cast("string").alias("state"), F.concat(F.lit("c"), "id").alias("state_code")
    ).union(spark.createDataFrame([("hot", "h")], "state STRING, state_code STRING"))
    key = lambda r: (r.state, r.state_code or "")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        for limit in (threshold, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found.append(sorted(lookup_join(df, dim, "state").collect(), key=key))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found[0] == found[1]
    assert sum(r.state == "hot" and r.state_code == "h" for r in found[0]) == 334


def test_conflicting_codes_are_listed(spark):
    codes = spark.createDataFrame(
        [("A", "a1"), ("A", "a0"), ("B", "b"), ("B", "b"), (None, "x"), ("C", None)],
        "state STRING, state_code STRING",
    )
    assert [tuple(r) for r in conflicting_codes(codes).collect()] == [("A", "a0", "a1")]


def test_hot_key_of_a_shuffle_join_is_split_between_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), "id"
        )
        dim = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = lookup_join(facts, dim, "k")
        sums = joined.agg(F.count(F.lit(1)), F.sum("v"))
        expected = facts.agg(F.count(F.lit(1)), F.sum(F.col("k") * 2)).first()
        assert sums.first() == expected
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_in_an_empty_dimension(spark):
    df = spark.createDataFrame([("A",)], "state STRING")
    dim = spark.createDataFrame([], "state STRING, state_code STRING")
    assert lookup_join(df, dim, "state").collect()[0].state_code is None
