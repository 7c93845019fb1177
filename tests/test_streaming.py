from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from riskloom.operators import learning
from riskloom.plans import catalog
from riskloom.plans.jobs import open_jdbc_dashboard, score_stream, train_on
from riskloom.sinks import messages as messages_sink
from riskloom.sinks.jdbc import STARTED, _note, _tagged, append_batch_jdbc, write_jdbc
from riskloom.sinks.messages import write_message_files
from riskloom.sources.jdbc import SPREAD_VALUES, JdbcTable, read_predictions
from riskloom.sources.sample_tables import case_scorer
from riskloom.streaming import sinks
from riskloom.streaming.live import live_distribution
from riskloom.streaming.once import without_copies
from riskloom.streaming.scoring import decode_reports, score_reports
from riskloom.streaming.sinks import (
    LARGE_STATE,
    STATE_STORE,
    claim,
    jdbc_batches,
    latest_result,
    parquet_batches,
    read_batches,
    read_latest,
    start_batches,
    start_files,
    stream_id,
)
from riskloom.streaming.sources import file_messages

TEXT = {"createTableColumnTypes": "state VARCHAR(64), county VARCHAR(64)"}


def report(i, **changes):
    body = {
        "state": f"S{i % 5}",
        "county": f"c{i}",
        "date": f"2023-01-{i % 28 + 1:02d}",
        "cases": i * 37 - 5,
        "deaths": i % 11,
        "mois": 1,
        "jour": i % 28 + 1,
    }
    return json.dumps({**body, **changes})


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def scored(messages):
    return score_reports(decode_reports(messages), case_scorer)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def table(name):
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    return JdbcTable("jdbc:derby:memory:tests;create=true", name, options)


@pytest.fixture
def inbox(folder):
    put(f"{folder}/in", "a.json", [report(i) for i in range(300)])
    bad = ["nope", report(1, date="bad"), report(2, cases=None), report(3, deaths="7"), ""]
    put(f"{folder}/in", "b.json", [report(i) for i in range(300, 500)] + bad)
    return folder


def test_messages_are_parsed_once(spark, inbox, plan_of):
    plan = plan_of(scored(spark.read.text(f"{inbox}/in")))
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("start", ["batches", "files"])
def test_stream_equals_batch_and_a_restart_adds_nothing(spark, inbox, start):
    expected = rows(scored(spark.read.text(f"{inbox}/in")))
    assert len(expected) == 500
    out, checkpoint = f"{inbox}/out", f"{inbox}/checkpoint"

    def run():
        stream = scored(file_messages(spark, f"{inbox}/in", max_files_per_trigger=1))
        if start == "batches":
            started = start_batches(stream, parquet_batches(out), checkpoint, available_now=True)
        else:
            started = start_files(stream, out, checkpoint, available_now=True)
        started.awaitTermination()
        read = read_batches(spark, out) if start == "batches" else spark.read.parquet(out)
        return rows(read)

    assert run() == expected
    assert run() == expected
    put(f"{inbox}/in", "c.json", [report(999)])
    assert len(run()) == 501


def test_a_backlog_is_cut_into_batches_by_size(spark, inbox):
    for i in range(4):
        put(f"{inbox}/in", f"more{i}.json", [report(1000 + 100 * i + j) for j in range(100)])
    expected = rows(scored(spark.read.text(f"{inbox}/in")))
    stream = scored(file_messages(spark, f"{inbox}/in", max_bytes_per_trigger=20_000))
    query = start_batches(
        stream, parquet_batches(f"{inbox}/out"), f"{inbox}/checkpoint", available_now=True
    )
    query.awaitTermination()
    assert len(os.listdir(f"{inbox}/out")) > 1
    assert rows(read_batches(spark, f"{inbox}/out")) == expected


def test_replayed_folder_batch_is_overwritten(spark, inbox):
    batch = scored(spark.read.text(f"{inbox}/in"))
    write = parquet_batches(f"{inbox}/out")
    write(batch.limit(3), 0, "s")
    write(batch, 0, "s")
    write(batch.limit(10), 1, "s")
    assert read_batches(spark, f"{inbox}/out").count() == 510


def test_stream_into_a_table_and_redelivery(spark, inbox):
    target = table("predictions_stream")
    write = jdbc_batches(target, **TEXT)
    stream = scored(file_messages(spark, f"{inbox}/in", max_files_per_trigger=1))
    start_batches(stream, write, f"{inbox}/checkpoint", available_now=True).awaitTermination()
    expected = rows(scored(spark.read.text(f"{inbox}/in")))
    back = read_predictions(spark, target, partitions=4)
    assert rows(back) == expected
    assert dict(back.dtypes)["date"] == "date"
    own = stream_id(spark, f"{inbox}/checkpoint")
    for name, number in (("a.json", 0), ("b.json", 1)):
        assert not write(scored(spark.read.text(f"{inbox}/in/{name}")), number, own)
    assert read_predictions(spark, target).count() == 500


def test_equal_rows_of_two_streams_are_both_kept(spark, inbox):
    target = table("predictions_two")
    expected = rows(scored(spark.read.text(f"{inbox}/in")))
    for checkpoint in ("one", "two", "two"):
        stream = scored(file_messages(spark, f"{inbox}/in"))
        start_batches(
            stream, jdbc_batches(target, **TEXT), f"{inbox}/{checkpoint}", available_now=True
        ).awaitTermination()
    assert rows(read_predictions(spark, target)) == sorted(expected * 2)


def test_a_fresh_checkpoint_on_a_used_folder_is_refused(spark, inbox):
    def run(checkpoint):
        stream = scored(file_messages(spark, f"{inbox}/in", max_files_per_trigger=1))
        start_batches(
            stream, parquet_batches(f"{inbox}/out"), f"{inbox}/{checkpoint}", available_now=True
        ).awaitTermination()

    run("first")
    before = rows(read_batches(spark, f"{inbox}/out"))
    with pytest.raises(StreamingQueryException, match="folder of its own"):
        run("second")
    assert rows(read_batches(spark, f"{inbox}/out")) == before
    run("first")
    with pytest.raises(ValueError, match="folder of its own"):
        claim(spark, f"{inbox}/out", "another")


def test_batch_cut_off_half_way_is_completed_with_its_copies(spark, inbox):
    batch = scored(spark.read.text(f"{inbox}/in"))
    batch = batch.union(batch.limit(20)).union(batch.limit(20))
    target = table("predictions_cut")
    append_batch_jdbc(batch.limit(0), target, 6, "s", **TEXT)
    _note(spark, target.beside("batches"), 7, "s", STARTED)
    write_jdbc(_tagged(batch.limit(100), 7, "s"), target)
    assert append_batch_jdbc(batch, target, 7, "s", **TEXT)
    assert not append_batch_jdbc(batch, target, 7, "s", **TEXT)
    assert append_batch_jdbc(batch, target, 8, "s", **TEXT)
    assert rows(read_predictions(spark, target)) == sorted(rows(batch) * 2)


def test_rows_of_a_task_that_ran_twice_are_read_once(spark, inbox):
    batch = scored(spark.read.text(f"{inbox}/in"))
    batch = batch.union(batch.limit(20))
    target = table("predictions_repeat")
    append_batch_jdbc(batch, target, 0, "s", **TEXT)
    written = target.scan(spark)
    again = written.where(f"spread < {SPREAD_VALUES // 2}").withColumn("spread", F.lit(5)).collect()
    assert 0 < len(again) < 520
    write_jdbc(spark.createDataFrame(again, written.schema), target)
    assert target.scan(spark).count() == 520 + len(again)
    assert rows(read_predictions(spark, target)) == rows(batch)
    append_batch_jdbc(batch, target, 0, "s", **TEXT)
    assert target.scan(spark).count() == 520 + len(again)


def test_rows_are_numbered_alike_whatever_their_order(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("a"), (F.col("id") % 7).alias("b"))
    numbered = lambda d: d.select("a", "b", "row_id").collect()
    first = numbered(_tagged(df.coalesce(1), 0, "s"))
    other = numbered(_tagged(df.coalesce(1).sortWithinPartitions(F.desc("b")), 0, "s"))
    assert first == other


def test_filters_pass_the_removal_of_repeats(spark, inbox, plan_of):
    target = table("predictions_push")
    append_batch_jdbc(scored(spark.read.text(f"{inbox}/in")), target, 0, "s", **TEXT)
    kept = read_predictions(spark, target).where("risk_category >= 3")
    assert "GreaterThanOrEqual(risk_category,3)" in plan_of(kept)


def test_table_without_spread_is_split_by_date(spark, inbox):
    target = table("predictions_plain")
    batch = scored(spark.read.text(f"{inbox}/in"))
    write_jdbc(batch, target, **TEXT)
    back = read_predictions(spark, target, partitions=3)
    assert back.rdd.getNumPartitions() == 3
    assert rows(back) == rows(batch)
    chosen = read_predictions(
        spark, target, predicates=['"risk_category" < 2', '"risk_category" >= 2']
    )
    assert chosen.rdd.getNumPartitions() == 2
    assert rows(chosen) == rows(batch)


def test_filters_reach_the_table(spark, inbox, plan_of):
    target = table("predictions_filter")
    write_jdbc(scored(spark.read.text(f"{inbox}/in")), target, **TEXT)
    kept = target.scan(spark).where("risk_category >= 3 and state = 'S1'")
    plan = plan_of(kept)
    assert "GreaterThanOrEqual(risk_category,3)" in plan and "EqualTo(state,S1)" in plan


def test_dashboard_on_a_table(spark, inbox):
    target = table("predictions_board")
    batch = scored(spark.read.text(f"{inbox}/in"))
    append_batch_jdbc(batch, target, 0, "s", **TEXT)
    board = open_jdbc_dashboard(spark, target)
    assert board.details_count().first().n == 500
    append_batch_jdbc(batch, target, 1, "s", **TEXT)
    board = board.refresh()
    assert board.details_count().first().n == 1000
    board.close()


def test_column_names_in_sql_text():
    assert JdbcTable("jdbc:postgresql://h/d").name("date") == '"date"'
    assert JdbcTable("jdbc:mysql://h/d").name("date") == "`date`"


def test_table_named_by_the_session(spark):
    assert JdbcTable.from_settings(spark) is None
    spark.conf.set("spark.riskloom.jdbc.url", "jdbc:derby:memory:tests")
    spark.conf.set("spark.riskloom.jdbc.password", "secret")
    try:
        named = JdbcTable.from_settings(spark)
        assert (named.url, named.table) == ("jdbc:derby:memory:tests", "risk_predictions")
        assert named.options == {"password": "secret"}
        assert "secret" not in repr(named)
    finally:
        spark.conf.unset("spark.riskloom.jdbc.url")
        spark.conf.unset("spark.riskloom.jdbc.password")


@pytest.mark.parametrize("kind,params", [("forest", {}), ("logistic", {}), ("svm", {"maxIter": 3})])
def test_stream_scored_by_a_saved_model(spark, inbox, kind, params):
    reports = decode_reports(spark.read.text(f"{inbox}/in"))
    trained = train_on(reports, kind, **params).model
    learning.save(trained, f"{inbox}/model")
    seen = {}
    score_stream(
        file_messages(spark, f"{inbox}/in", max_files_per_trigger=1),
        learning.load(spark, f"{inbox}/model"),
        parquet_batches(f"{inbox}/out"),
        f"{inbox}/checkpoint",
        available_now=True,
        rejected=parquet_batches(f"{inbox}/rejected"),
        on_counts=lambda batch_id, counts: seen.update({batch_id: counts}),
    ).awaitTermination()
    batch = score_reports(reports, lambda df: learning.predict(trained, df))
    assert rows(read_batches(spark, f"{inbox}/out")) == rows(batch)
    assert len(seen) == 2 and sum(c["messages"] for c in seen.values()) == 505
    assert sum(c["good"] for c in seen.values()) == 500
    kept = [r.fault for r in read_batches(spark, f"{inbox}/rejected").collect()]
    assert sorted(kept) == sorted(
        ["undecodable", "bad_date", "missing_count", "missing_count", "undecodable"]
    )


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_live_counts_follow_the_calendar_day_in_any_zone(spark, folder, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        data = [
            (dt.datetime(2023, 3, d, h), f"c{h % 2}") for d in (11, 12, 13) for h in (0, 2, 11, 23)
        ]
        schema = "ts TIMESTAMP_NTZ, kind STRING"
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        start_batches(
            live_distribution(stream, "kind", "ts"),
            latest_result(f"{folder}/out"),
            f"{folder}/checkpoint",
            available_now=True,
            output_mode="complete",
        ).awaitTermination()
        got = {(r.day, r.kind): r.n for r in read_latest(spark, f"{folder}/out").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {(dt.date(2023, 3, d), k): 2 for d in (11, 12, 13) for k in ("c0", "c1")}


def test_days_in_any_order_are_counted_in_update_mode(spark, folder):
    schema = "date DATE, risk_category INT"
    counts = {}

    def keep(batch, batch_id, stream):
        counts.update({(r.day.day, r.risk_category): r.n for r in batch.collect()})
        return True

    for name, days in (("a", [20, 20]), ("b", [1, 2, 3]), ("c", [4, 5, 1]), ("d", [31, 20])):
        data = [(dt.date(2023, 1, d), 3) for d in days] + [(None, 3), (dt.date(2023, 1, 9), None)]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(
            f"{folder}/in"
        )
        start_batches(
            live_distribution(stream), keep, f"{folder}/checkpoint", available_now=True,
            output_mode="update",
        ).awaitTermination()
    assert counts == {(20, 3): 3, (1, 3): 2, (2, 3): 1, (3, 3): 1, (4, 3): 1, (5, 3): 1, (31, 3): 1}
    with pytest.raises(AnalysisException):
        start_files(live_distribution(stream), f"{folder}/out", f"{folder}/append")


def test_offsets_and_limits_reach_the_source(monkeypatch):
    from riskloom.__main__ import _messages, arguments

    handed = {}
    monkeypatch.setattr("riskloom.__main__.kafka_messages", lambda *a, **k: handed.update(k))
    monkeypatch.setattr("riskloom.__main__.file_messages", lambda *a: handed.update(files=a[2:]))
    score = ["score", "m", "--checkpoint", "c"]
    _messages(None, arguments().parse_args([*score, "--servers", "h:1", "--min-partitions", "7"]))
    assert handed["max_offsets_per_trigger"] > 0 and handed["min_partitions"] == 7
    assert handed["fail_on_data_loss"] is True
    _messages(None, arguments().parse_args([*score, "--folder", "f"]))
    assert handed["files"][0] is None and handed["files"][1] > 0
    _messages(None, arguments().parse_args([*score, "--folder", "f", "--max-files", "3"]))
    assert handed["files"] == (3, None)


def test_late_rows_are_counted_until_the_watermark_passes(spark, folder):
    schema = "date DATE, risk_category INT"

    def add(name, days):
        data = [(dt.date(2023, 1, d), 3) for d in days]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(
            f"{folder}/in"
        )
        counts = live_distribution(stream, lateness="2 days")
        start_files(
            counts, f"{folder}/out", f"{folder}/checkpoint", available_now=True
        ).awaitTermination()
        return {r.day.day: r.n for r in spark.read.schema("day DATE, risk_category INT, n LONG").parquet(f"{folder}/out").collect()}

    add("a", [1, 2])
    run()
    add("b", [1, 2, 10])
    run()
    add("c", [1, 20])
    final = run()
    assert final[1] == 2 and final[2] == 2


def test_reports_sent_again_are_left_out(spark, folder):
    bad = "no report"
    undated = report(7, date="some day")
    put(f"{folder}/in", "a", [report(1), report(1), report(2), bad, bad])
    messages = file_messages(spark, f"{folder}/in")
    out = f"{folder}/out"

    def run():
        start_files(
            without_copies(messages, "30 days"), out, f"{folder}/checkpoint", available_now=True
        ).awaitTermination()
        return sorted(r.value for r in spark.read.schema("value string").parquet(out).collect())

    assert run() == sorted([report(1), report(2), bad, bad])
    put(f"{folder}/in", "b", [report(2), report(3), undated])
    assert run() == sorted([report(1), report(2), report(3), bad, bad, undated])
    # A corrected count is another report; the same report late is left out, first or not.
    put(f"{folder}/in", "c", [report(1, cases=77), report(4, date="2040-01-01")])
    assert len(run()) == 8
    put(f"{folder}/in", "d", [report(1), report(5, date="2030-01-01")])
    assert len(run()) == 8
    batch = without_copies(spark.read.text(f"{folder}/in"), "30 days")
    assert batch.count() == 9

def test_decoded_copies_are_not_parsed_again(spark, folder, plan_of):
    lines = [report(1), report(1), report(2), report(3, cases="x"), report(4, date="some day")]
    put(f"{folder}/in", "a", [*lines, "no report"])
    messages = spark.read.text(f"{folder}/in")
    bodies = without_copies(messages, "30 days")
    decoded = without_copies(messages, "30 days", decoded=True)
    assert rows(decoded.select("value")) == rows(bodies)
    reports = decode_reports(decoded)
    assert reports.columns == decode_reports(bodies).columns
    assert sorted(map(str, reports.collect())) == sorted(map(str, decode_reports(bodies).collect()))
    # Once for the dated messages, once for the others.
    assert plan_of(reports).count("from_json(") == 2


def test_state_of_reports_sent_again_is_kept_off_the_heap(spark, folder, monkeypatch):
    monkeypatch.setattr(learning, "predict", lambda model, rows: case_scorer(rows))
    put(f"{folder}/in", "a", [report(1), report(1), report(2)])
    messages = file_messages(spark, f"{folder}/in")
    store = f"{STATE_STORE}.providerClass"

    def run(name):
        writer = parquet_batches(f"{folder}/{name}-out")
        started = score_stream(
            messages, None, writer, f"{folder}/{name}", available_now=True, once="30 days"
        )
        started.awaitTermination()
        assert all(spark.conf.get(key, None) is None for key in LARGE_STATE)
        used = [p["stateOperators"][0]["customMetrics"] for p in started.recentProgress]
        kept = read_batches(spark, f"{folder}/{name}-out")
        return sorted(r.county for r in kept.collect()), any("rocksdbPutCount" in u for u in used)

    with monkeypatch.context() as older:
        older.setattr(sinks, "LARGE_STATE", {})
        assert run("older") == (["c1", "c2"], False)
    assert run("checkpoint") == (["c1", "c2"], True)
    put(f"{folder}/in", "b", [report(2), report(3), report(3)])
    assert run("checkpoint") == (["c1", "c2", "c3"], True)
    # A checkpoint of the store in memory goes on with it, and a session's own choice stands.
    assert run("older") == (["c1", "c2", "c3"], False)
    with sinks._defaults(spark, {store: "another"}):
        with sinks._defaults(spark, LARGE_STATE):
            assert spark.conf.get(store) == "another"
        assert spark.conf.get(store) == "another"


def test_compressed_messages_are_the_same_on_less_disk(spark, folder, monkeypatch):
    monkeypatch.setattr(messages_sink, "MESSAGES_PER_FILE", 400)
    rows_in = decode_reports(spark.createDataFrame([(report(i),) for i in range(1000)], "value STRING"))
    rows_in = rows_in.withColumn("date", F.col("date").cast("date")).coalesce(1)
    write_message_files(rows_in, f"{folder}/plain")
    write_message_files(rows_in, f"{folder}/small", compressed=True)
    sizes = {
        name: [os.path.getsize(f"{folder}/{name}/{f}") for f in os.listdir(f"{folder}/{name}") if f[:4] == "part"]
        for name in ("plain", "small")
    }
    assert len(sizes["small"]) == 3  # none longer than 400 messages
    assert sum(sizes["small"]) < sum(sizes["plain"]) / 4
    assert rows(spark.read.text(f"{folder}/small")) == rows(spark.read.text(f"{folder}/plain"))
    start_files(
        file_messages(spark, f"{folder}/small", max_bytes_per_trigger=1),
        f"{folder}/out",
        f"{folder}/checkpoint",
        available_now=True,
    ).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(spark.read.text(f"{folder}/plain"))


def test_messages_sent_twice_are_kept_compressed_and_found(spark, folder, monkeypatch):
    lines = [report(i) for i in range(300)]
    sent = decode_reports(spark.createDataFrame([(line,) for line in lines], "value STRING"))
    sent = sent.withColumn("date", F.col("date").cast("date")).drop("mois", "jour")
    monkeypatch.setattr(catalog.sample, "reports", lambda *_: sent)
    monkeypatch.setattr(catalog, "shared_folder", lambda *_: f"{folder}/run")
    found = catalog.stream_deduplicated(spark, "none")
    assert found.count() == sent.dropna().distinct().count()
    written = [f for _, _, names in os.walk(f"{folder}/run/messages") for f in names if f[:4] == "part"]
    assert written and all(f.endswith(".gz") for f in written)
    with open(f"{folder}/run/checkpoint/offsets/0") as offsets:
        assert f'"{STATE_STORE}.compression.codec":"zstd"' in offsets.read()
