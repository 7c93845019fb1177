"""What follows a stream or an arrival: summaries, finished days, compacted folders, raw files."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from riskloom.operators import report
from riskloom.plans import jobs
from riskloom.sinks.versions import latest_version, numbered
from riskloom.sources.reports import read_reports, resolve_feeds
from riskloom.streaming.arrivals import arrival_counts, arriving_reports, start_ingest
from riskloom.streaming.live import finished_days, late_groups, open_days, usable_rows
from riskloom.streaming.sinks import (
    compact_batches,
    latest_result,
    parquet_batches,
    read_batches,
    read_latest,
    start_batches,
)
from riskloom.streaming.summary import read_summary, summary_batches

PREDICTIONS = (
    "state STRING, county STRING, date DATE, risk_category INT, predicted_risk_category INT"
)


def predictions(spark, days, n=1):
    data = [
        (s, f"c{i}", d and dt.date(2023, *d), c, c)
        for d in days
        for i in range(n)
        for s, c in (("Texas", 3), ("Ohio", i % 5), (None, None))
    ]
    return spark.createDataFrame(data, PREDICTIONS)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_summary_equals_a_full_count_after_each_batch_and_replay(spark, folder):
    path, write = f"{folder}/summary", summary_batches(f"{folder}/summary")
    batches = [
        predictions(spark, [(1, 1), (1, 2), (2, 1)], 3),
        predictions(spark, [(2, 1), (3, 1), None], 7),
        predictions(spark, []),
        predictions(spark, [(1, 2), None], 2),
    ]
    assert read_summary(spark, path).count() == 0
    seen = None
    for i, batch in enumerate(batches):
        assert write(batch, i, "s") is True
        assert write(batch, i, "s") is False
        seen = batch if seen is None else seen.union(batch)
        assert rows(read_summary(spark, path)) == rows(report.summarise(seen))
    with pytest.raises(ValueError, match="stream"):
        write(batches[0], 4, "another")
    board = jobs.open_dashboard(seen, kept_summary=lambda: read_summary(spark, path))
    plain = jobs.open_dashboard(seen)
    try:
        assert rows(board.risk_over_time()) == rows(plain.risk_over_time())
        assert rows(board.top_high_risk_states()) == rows(plain.top_high_risk_states())
        write(predictions(spark, [(4, 1)]), 4, "s")
        fresh = board.refresh()
        assert fresh.summary.agg(F.sum(report.WEIGHT)).first()[0] == seen.count() + 3
        fresh.close()
    finally:
        plain.close()


def test_summary_writes_touched_months_only_and_keeps_few_versions(spark, folder):
    path = f"{folder}/summary"
    write = summary_batches(path, keep=2)
    write(predictions(spark, [(1, 1), (2, 1)]), 0, "s")
    early = read_summary(spark, path)
    for i in range(1, 6):
        write(predictions(spark, [(2, i)]), i, "s")
        if i == 1:
            assert early.count() == 6  # a reader of the version before is not disturbed
    number, last = latest_version(spark, path)
    assert (number, last["batch"]) == (5, 5)
    assert last["months"] == {"2023-01": 0, "2023-02": 5}
    assert numbered(spark, path, "version") == [4, 5]
    assert numbered(spark, path, "rows") == [0, 4, 5]


def test_a_batch_that_broke_off_is_added_whole(spark, folder):
    path = f"{folder}/summary"
    summary_batches(path)(predictions(spark, [(1, 1)]), 0, "s")
    # Rows of the next version without the version, and a version without its mark.
    predictions(spark, [(5, 5)]).write.parquet(f"{path}/rows=1/month=2023-01")
    os.makedirs(f"{path}/version=1")
    before = rows(read_summary(spark, path))
    assert before == rows(report.summarise(predictions(spark, [(1, 1)])))
    summary_batches(path)(predictions(spark, [(1, 1)]), 1, "s")
    assert sum(r.report_rows for r in read_summary(spark, path).collect()) == 6


def test_compaction_beside_readers_and_the_stream(spark, folder):
    path = f"{folder}/out"
    write = parquet_batches(path)
    for i in range(5):
        write(spark.range(10 * i, 10 * i + 10), i, "s")
    expected = list(range(50))
    before = read_batches(spark, path)
    assert compact_batches(spark, path) and not compact_batches(spark, path)
    values = lambda df: sorted(r.id for r in df.collect())
    assert values(before) == values(read_batches(spark, path)) == expected
    # The newest batch is not compacted and can come again; an older one changes nothing.
    assert write(spark.range(40, 50), 4, "s") is True
    assert write(spark.range(0, 10), 0, "s") is False
    assert values(read_batches(spark, path)) == expected
    middle = read_batches(spark, path)
    for i in range(5, 8):
        write(spark.range(10 * i, 10 * i + 10), i, "s")
        compact_batches(spark, path)
        if i == 5:
            assert values(middle) == expected
    assert values(read_batches(spark, path)) == list(range(80))
    assert numbered(spark, path, "batch_id") == [6, 7]
    assert len(numbered(spark, f"{path}/_compacted", "segment")) == 2


def test_large_segments_are_not_written_again(spark, folder):
    path = f"{folder}/out"
    write = parquet_batches(path)
    for i in range(6):
        write(spark.range(10 * i, 10 * i + 10), i, "s")
        compact_batches(spark, path, segment_bytes=1)
    _, last = latest_version(spark, f"{path}/_compacted")
    assert last == {"upto": 4, "segments": [0, 1, 2, 3, 4]}
    assert read_batches(spark, path).count() == 60


def test_latest_result_is_whole_and_old_ones_go(spark, folder):
    path = f"{folder}/out"
    write = latest_result(path, keep=2)
    for i in range(4):
        write(spark.range(i + 1), i, "s")
    spark.range(99).write.parquet(f"{path}/batch_id=4")
    os.remove(f"{path}/batch_id=4/_SUCCESS")
    assert read_latest(spark, path).count() == 4
    assert numbered(spark, path, "batch_id") == [2, 3]


def test_late_reports_are_the_difference(spark, folder):
    schema = "date DATE, risk_category INT"
    told = []

    def run(name, days):
        data = [(dt.date(2023, 1, d), c) for d, c in days] + [(None, 1), (dt.date(2023, 1, 1), None)]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/*")
        query = start_batches(
            finished_days(stream, "2 days"),
            parquet_batches(f"{folder}/days"),
            f"{folder}/checkpoint",
            available_now=True,
        )
        query.awaitTermination()
        told.append((sum(usable_rows(query).values()), sum(late_groups(query).values())))

    run("a", [(1, 1), (1, 1), (2, 1), (10, 2)])
    run("b", [(1, 1), (1, 1), (1, 3), (8, 1), (7, 1), (20, 1)])
    # Day 7 ends where the watermark of the first run stands, so it is over; day 8 is not.
    assert told == [(4, 0), (6, 3)]
    given = {(r.day.day, r.risk_category): r.n for r in read_batches(spark, f"{folder}/days").collect()}
    still = {(r.day.day, r.risk_category): r.n for r in open_days(spark, f"{folder}/checkpoint").collect()}
    assert given == {(1, 1): 2, (2, 1): 1, (10, 2): 1, (8, 1): 1}
    assert still == {(20, 1): 1}
    assert 10 - sum(given.values()) - sum(still.values()) == 4


def put(folder, name, lines, header="date,county,state,cases,deaths"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write("\n".join([header, *lines]) + "\n")


def test_each_raw_file_once(spark, folder):
    def run():
        query = start_ingest(
            arriving_reports(spark, f"{folder}/raw"),
            f"{folder}/raw",
            f"{folder}/curated",
            f"{folder}/checkpoint",
            keys=["annee", "mois"],
            spread=4,
        )
        query.awaitTermination()
        return [c for c in arrival_counts(query).values() if c["rows"]]

    put(f"{folder}/raw", "a.csv", ["1/2/2023,c,Texas,5,1", "bad,c,Texas,5,1", "1/3/2023,c,Texas,x,1"])
    assert run() == [{"rows": 3, "unparsed_dates": 1, "unreadable_lines": 1}]
    assert run() == []
    put(f"{folder}/raw", "b.csv", ["1/2/2024,c,Ohio,,2"] * 500)
    assert run() == [{"rows": 500, "unparsed_dates": 0, "unreadable_lines": 0}]
    found = read_reports(spark, f"{folder}/curated")
    assert found.count() == 503 and found.where("date IS NULL").count() == 1
    assert read_reports(spark, f"{folder}/curated", year=2024).count() == 500
    put(f"{folder}/raw", "c.csv", ["Ohio,c,1/2/2024,1,2"], "state,county,date,cases,deaths")
    with pytest.raises(StreamingQueryException):
        run()
    assert read_reports(spark, f"{folder}/curated").count() == 503


def test_the_output_of_arrivals_may_not_lie_in_the_input(spark, folder):
    put(f"{folder}/raw", "a.csv", ["1/2/2023,c,Texas,5,1"])
    with pytest.raises(ValueError, match="overlaps"):
        start_ingest(
            arriving_reports(spark, f"{folder}/raw"), f"{folder}/raw", f"{folder}/raw/out", folder
        )


FEED = "state STRING, date DATE, cases INT, deaths INT"


def feed(spark, *data):
    return spark.createDataFrame([(s, d and dt.date(2023, 1, d), *c) for s, d, *c in data], FEED)


def test_the_trusted_feed_wins_then_the_newest_then_the_largest(spark):
    first = feed(spark, ("A", 1, 5, None), ("A", 2, 4, 1), ("A", 2, 4, None), ("B", None, 9, 9))
    second = feed(spark, ("A", 9, 99, 9), ("C", 1, 7, 7), ("C", 1, 7, 7), (None, 1, 1, 1), (None, 1, 1, 1))
    third = feed(spark, ("B", 3, 9, 9), ("C", 5, 8, 8)).drop("deaths")
    found = resolve_feeds({"x": first, "y": second, "z": third}, ["state"], "date")
    got = {r.state: r for r in found.where("state IS NOT NULL").collect()}
    assert [(s, r.date and r.date.day, r.cases, r.deaths) for s, r in sorted(got.items())] == [
        ("A", 2, 4, 1), ("B", None, 9, 9), ("C", 1, 7, 7)
    ]
    assert {s: (r.source, r.sources, r.reports, r.differing) for s, r in got.items()} == {
        "A": ("x", ["x", "y"], 4, ["cases", "deaths"]),
        "B": ("x", ["x", "z"], 2, []),
        "C": ("y", ["y", "z"], 3, ["cases"]),
    }
    keyless = found.where("state IS NULL").collect()
    assert [(r.source, r.sources, r.reports) for r in keyless] == [("y", ["y"], 1)] * 2


def test_feeds_without_rows_or_with_clashing_names(spark):
    empty = feed(spark)
    assert resolve_feeds({"x": empty, "y": empty}, ["state", "date"], "date").count() == 0
    with pytest.raises(ValueError, match="reports"):
        resolve_feeds({"x": empty.withColumn("reports", F.lit(1))}, ["state"], "date")


def test_a_hot_key_of_a_feed_is_combined_before_the_shuffle(spark, plan_of):
    hot = feed(spark, ("A", 1, 5, 5)).crossJoin(spark.range(1000)).drop("id")
    found = resolve_feeds({"x": hot, "y": hot}, ["state"], "date")
    assert found.first().reports == 2000
    assert "partial_max" in plan_of(found)


def test_selection_leaves_out_what_cannot_be_fitted(spark):
    data = [
        ("S", f"c{i}", dt.date(2023, 1, i % 28 + 1), i * 40 - 100, i % 3, 1, i % 28 + 1)
        for i in range(400)
    ]
    schema = "state STRING, county STRING, date DATE, cases INT, deaths INT, mois INT, jour INT"
    reports = spark.createDataFrame(data, schema).where("cases < 0 OR cases >= 2000")
    candidates = {
        "none": jobs.Candidate("svm", {"maxIter": 2}),
        "flat": jobs.Candidate("forest", {"numTrees": 1, "maxDepth": 1, "subsamplingRate": 0.1}),
        "deep": jobs.Candidate("forest", {"numTrees": 5, "maxDepth": 5}),
    }
    found = jobs.select_model(reports, candidates, 2)
    assert found.accuracy["none"] == [None, None] and found.mean("none") is None
    assert found.best == "deep" and found.mean("deep") > 0.9
    assert found.scores(spark).count() == 6
    with pytest.raises(ValueError, match="no candidate"):
        jobs.select_model(reports, {"none": candidates["none"]}, 2)
    with pytest.raises(ValueError, match="folds"):
        jobs.select_model(reports, candidates, 1)
