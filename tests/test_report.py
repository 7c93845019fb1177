"""Dashboard operators against pandas on frames with nulls, unknown codes and ties."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.constants import RISK_LABELS
from riskloom.operators import report
from riskloom.plans.jobs import open_dashboard

SCHEMA = "state STRING, county STRING, date DATE, risk_category INT, predicted_risk_category INT"
COLUMNS = ["state", "county", "date", "risk_category", "predicted_risk_category"]


def random_rows(seed, n=400):
    pick = random.Random(seed).choice
    days = [dt.date(2023, 1, d) for d in range(1, 6)] + [None]
    return [
        (
            pick(["A", "A", "A", "B", "C", "D", None]),
            pick(["x", "y", "z", None]),
            pick(days),
            pick([0, 1, 2, 3, 4, 9, None]),
            pick([0, 1, 2, 3, 4, None]),
        )
        for _ in range(n)
    ]


@pytest.fixture(params=[1, 2, 3])
def rows(request):
    return random_rows(request.param)


@pytest.fixture
def frames(spark, rows):
    pdf = pd.DataFrame(rows, columns=COLUMNS)
    pdf["date"] = pd.to_datetime(pdf["date"])
    pdf["risk_category_text"] = pdf["risk_category"].map(RISK_LABELS)
    return spark.createDataFrame(rows, SCHEMA), pdf


CODES = [("A", "AA"), ("B", "BB"), ("X", "XX")]


def codes(spark):
    return spark.createDataFrame(CODES, "state STRING, state_code STRING")


def sides(df):
    """The detail rows and their summary must give the same answers."""
    return [df, report.summarise(df)]


def test_category_distribution(frames):
    df, pdf = frames
    expected = pdf["risk_category_text"].value_counts()
    for side in sides(df):
        got = report.category_distribution(side).collect()
        assert {r.risk_category_text: r.n for r in got} == expected.to_dict()
        assert [r.n for r in got] == sorted(expected, reverse=True)


def test_distribution_by_text_where_there_is_no_code(frames):
    df, pdf = frames
    text = report.enrich_predictions(df).drop("risk_category")
    got = {r.risk_category_text: r.n for r in report.category_distribution(text).collect()}
    assert got == pdf["risk_category_text"].value_counts().to_dict()


def test_actual_vs_predicted(frames):
    df, pdf = frames
    expected = pdf.groupby(["risk_category", "predicted_risk_category"]).size()
    for side in sides(df):
        got = report.actual_vs_predicted(side).collect()
        assert [((r.risk_category, r.predicted_risk_category), r.n) for r in got] == list(
            expected.items()
        )


def test_confusion_matrix(frames):
    df, pdf = frames
    pairs = pdf.groupby(["risk_category", "predicted_risk_category"]).size().to_dict()
    for side in sides(df):
        for r in report.confusion_matrix(side).collect():
            for p in range(5):
                assert r[f"predicted_{p}"] == pairs.get((r.risk_category, p), 0)


def test_risk_over_time(frames):
    df, pdf = frames
    expected = pdf.groupby([pd.Grouper(key="date", freq="D"), "risk_category_text"]).size()
    for side in sides(df):
        got = report.risk_over_time(side).collect()
        assert [((pd.Timestamp(r.date), r.risk_category_text), r.n) for r in got] == list(
            expected.items()
        )


def test_risk_over_time_of_timestamps(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2023, 1, 2, h), 3) for h in (0, 12, 23)], "date TIMESTAMP_NTZ, risk_category INT"
    )
    (row,) = report.risk_over_time(df).collect()
    assert (row.date, row.n) == (dt.date(2023, 1, 2), 3)


def test_mean_risk_by_state(spark, frames):
    df, pdf = frames
    pdf["state_code"] = pdf["state"].map(dict(CODES))
    expected = pdf.groupby(["state", "state_code"])["risk_category"].mean()
    enriched = report.enrich_predictions(df, codes(spark))
    summary = report.summarise(df, codes(spark))
    results = [report.mean_risk_by_state(df, codes(spark))]
    results += [report.mean_risk_by_state(side) for side in (enriched, summary)]
    for result in results:
        got = [((r.state, r.state_code), r.risk_level) for r in result.collect()]
        assert got == list(expected.items())


def test_unmatched_states(spark, frames):
    df, pdf = frames
    expected = pdf[pdf["state"].isin(["C", "D"])]["state"].value_counts().sort_index()
    for side in sides(df):
        got = report.unmatched_states(side, codes(spark)).collect()
        assert [(r.state, r.n) for r in got] == list(expected.items())


def test_mean_risk_without_codes(frames):
    df, pdf = frames
    expected = pdf.groupby("state")["risk_category"].mean()
    for side in sides(df):
        got = report.mean_risk_by_state(side, with_codes=False).collect()
        assert {r.state: r.risk_level for r in got} == expected.to_dict()
        assert [r.risk_level for r in got] == sorted(expected, reverse=True)


def test_top_high_risk_states(frames):
    df, pdf = frames
    risky = pdf[pdf["risk_category"] >= 3]
    expected = risky["state"].value_counts().to_dict()
    for side in sides(df):
        got = {r.state: r.high_risk_rows for r in report.top_high_risk_states(side).collect()}
        assert got == expected
    distinct = {
        r.state: r.high_risk_counties
        for r in report.top_high_risk_states(df, distinct=True).collect()
    }
    assert distinct == risky.groupby("state")["county"].nunique().to_dict()


def test_ties_at_the_cut_go_to_the_first_names(spark):
    rows = [(f"S{i:02d}", "x", None, 3, 3) for i in range(12) for _ in range(2)]
    got = report.top_high_risk_states(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.state for r in got] == [f"S{i:02d}" for i in range(10)]
    assert report.top_high_risk_states(spark.createDataFrame(rows, SCHEMA), k=3).count() == 3


def test_high_risk_table(frames):
    df, pdf = frames
    risky = pdf[pdf["risk_category"] >= 3].sort_values(["state", "county"])
    got = report.high_risk_table(df).collect()
    key = lambda pairs: [(s or None, c or None) for s, c in pairs]
    assert [(r.State, r.County) for r in got] == key(zip(risky["state"], risky["county"]))
    assert got[0].asDict().keys() == {"State", "County", "Date", "Risk Category"}


def test_sort_of_the_high_risk_table_cuts_through_a_hot_county(spark):
    df = spark.range(0, 200_000, 1, 16).select(
        F.lit("A").alias("state"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("county"),
        F.lit("2023-01-02").cast("date").alias("date"),
        F.lit(4).alias("risk_category"),
    )
    table = report.high_risk_table(df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        holding = table.where("County = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
        counts = [r["count"] for r in holding.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(counts) == 66_667
    assert len(counts) > 1


def test_options(frames):
    df, pdf = frames
    expected = (
        pdf["date"].min().date(),
        pdf["date"].max().date(),
        pdf["state"].nunique(),
        pdf["risk_category"].nunique(),
    )
    for side in sides(df):
        assert tuple(report.filter_options(side).first()) == expected
        assert tuple(report.date_bounds(side).first()) == expected[:2]
    states = [r.state for r in report.distinct_values(df, "state").collect()]
    assert states == sorted(pdf["state"].dropna().unique())


def test_risk_options(frames):
    df, pdf = frames
    seen = set(pdf["risk_category_text"].dropna())
    by_code = [label for label in RISK_LABELS.values() if label in seen]
    text = report.enrich_predictions(df)
    labels = lambda options: [r.risk_category_text for r in options.collect()]
    assert labels(report.risk_options(df)) == by_code
    assert labels(report.risk_options(text)) == sorted(seen)
    assert labels(report.risk_options(text.drop("risk_category"))) == sorted(seen)


@pytest.mark.parametrize(
    "filters",
    [
        {},
        {"state": "All", "risk": "All"},
        {"state": "A"},
        {"risk": "High"},
        {"risk": 3},
        {"risk": "No such label"},
        {"start": dt.date(2023, 1, 2), "end": dt.date(2023, 1, 4)},
        {"start": "2023-01-02"},
        {"state": "A", "risk": "Low", "start": "2023-01-01", "end": "2023-01-03"},
    ],
)
def test_filters(frames, filters):
    df, pdf = frames
    kept = pdf
    if filters.get("state", "All") != "All":
        kept = kept[kept["state"] == filters["state"]]
    risk = filters.get("risk", "All")
    if risk != "All":
        kept = kept[(kept["risk_category_text"] == risk) | (kept["risk_category"] == risk)]
    if "start" in filters and "end" in filters:
        low, high = pd.Timestamp(filters["start"]), pd.Timestamp(filters["end"])
        kept = kept[(kept["date"] >= low) & (kept["date"] <= high)]
    assert report.filter_predictions(df, **filters).count() == len(kept)
    for side in sides(df):
        assert report.filtered_count(side, **filters).first().n == len(kept)
    text = report.enrich_predictions(df).drop("risk_category")
    if not isinstance(risk, int):
        assert report.filter_predictions(text, **filters).count() == len(kept)


def test_filters_reach_the_scan(spark, folder, plan_of):
    spark.createDataFrame(random_rows(5), SCHEMA).write.parquet(folder + "/p")
    df = report.enrich_predictions(spark.read.parquet(folder + "/p"))
    kept = report.filter_predictions(df, "A", "High", "2023-01-01", "2023-01-03")
    plan = plan_of(kept)
    for part in ("EqualTo(state,A)", "EqualTo(risk_category,3)", "GreaterThanOrEqual(date,2023-01-01)"):
        assert part in plan


def test_display_view(spark):
    df = spark.createDataFrame([("A", "x", dt.date(2023, 1, 2), 3, 9)], SCHEMA)
    expected = ("A", "x", dt.date(2023, 1, 2), "High", None)
    names = ["State", "County", "Date", "Risk Category", "Predicted Risk"]
    for side in (df, report.enrich_predictions(df)):
        view = report.display_view(side)
        assert view.columns == names
        assert tuple(view.first()) == expected
    bare = report.display_view(df.drop("risk_category", "predicted_risk_category"))
    assert bare.columns == ["State", "County", "Date", "Predicted Risk"]
    assert bare.first()["Predicted Risk"] is None


def test_enriched_load_time(spark):
    df = spark.createDataFrame([("Texas", "x", dt.date(2023, 1, 2), 3, 4)], SCHEMA)
    row = report.enrich_predictions(df).first()
    dt.datetime.strptime(row.timestamp, "%Y-%m-%d %H:%M:%S")
    assert (row.state_code, row.risk_category_text, row.predicted_risk_category_text) == (
        "TX", "High", "Very High"
    )


def test_dashboard(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    board = open_dashboard(df, codes(spark))
    try:
        assert not board.is_empty()
        assert board.category_distribution().collect() == report.category_distribution(df).collect()
        assert board.risk_over_time().collect() == report.risk_over_time(df).collect()
        assert (
            board.mean_risk_by_state().collect()
            == report.mean_risk_by_state(df, codes(spark)).collect()
        )
        assert board.top_high_risk_states().collect() == report.top_high_risk_states(df).collect()
        assert board.actual_vs_predicted().collect() == report.actual_vs_predicted(df).collect()
        assert board.filter_options().collect() == report.filter_options(df).collect()
        assert board.details(state="A").count() == df.where("state = 'A'").count()
        assert board.details_count(state="A").first().n == df.where("state = 'A'").count()
        distinct = board.top_high_risk_states(distinct=True).collect()
        assert distinct == report.top_high_risk_states(df, distinct=True).collect()
        assert board.risk_options().collect() == report.risk_options(df).collect()
        assert board.state_options().count() == 4
        assert board.high_risk_table().count() == df.where("risk_category >= 3").count()
    finally:
        board.close()


def test_refreshed_dashboard_sees_new_predictions(spark, rows, folder):
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{folder}/p")
    board = open_dashboard(lambda: spark.read.parquet(f"{folder}/p"), codes(spark))
    assert board.details_count().first().n == len(rows)
    df.write.mode("append").parquet(f"{folder}/p")
    board = board.refresh()
    assert board.details_count().first().n == board.details().count() == 2 * len(rows)
    board.close()


def test_distinct_counties_need_the_predictions(spark, rows):
    summary = report.summarise(spark.createDataFrame(rows, SCHEMA))
    with pytest.raises(Exception, match="county"):
        report.top_high_risk_states(summary, distinct=True).collect()


def test_empty_predictions(spark):
    empty = spark.createDataFrame([], SCHEMA)
    board = open_dashboard(empty)
    assert board.is_empty()
    assert board.category_distribution().count() == 0
    assert board.top_high_risk_states().count() == 0
    assert report.high_risk_table(empty).count() == 0
    assert tuple(report.filter_options(empty).first()) == (None, None, 0, 0)
    board.close()
