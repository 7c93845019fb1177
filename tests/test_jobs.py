"""The command line, from raw CSV to the exported details."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from riskloom.__main__ import main
from riskloom.operators import learning
from riskloom.plans import jobs
from riskloom.sinks.messages import write_message_files
from riskloom.sources.sample_tables import reports


def test_all_jobs_in_turn(spark, sf_dir, folder, capsys):
    raw = reports(spark, sf_dir).select(
        F.date_format("date", "M/d/yyyy").alias("date"), "county", "state", "cases", "deaths"
    )
    raw.write.csv(f"{folder}/raw", header=True)
    complete = raw.dropna().count()

    main(["ingest", f"{folder}/raw", f"{folder}/curated", "--keys", "annee"])
    assert f"rows={raw.count()}" in capsys.readouterr().out
    main(["train", f"{folder}/curated", f"{folder}/model"])
    assert "accuracy" in capsys.readouterr().out
    main(["publish", f"{folder}/curated", "--folder", f"{folder}/messages"])
    assert spark.read.text(f"{folder}/messages").count() == complete
    score = ["score", f"{folder}/model", "--folder", f"{folder}/messages", "--available-now"]
    main([*score, "--output", f"{folder}/scored", "--checkpoint", f"{folder}/checkpoint"])
    main([*score, "--output", f"{folder}/scored", "--checkpoint", f"{folder}/checkpoint"])
    scored = spark.read.parquet(f"{folder}/scored")
    assert scored.count() == complete
    assert scored.where("risk_category = predicted_risk_category").count() > 0.9 * complete
    main(["report", "--predictions", f"{folder}/scored", "--risk", "High", "--export", f"{folder}/csv"])
    assert "high_risk_rows" in capsys.readouterr().out
    assert glob.glob(f"{folder}/csv/details/*.csv")
    exported = spark.read.csv(f"{folder}/csv/details", header=True)
    assert exported.count() == scored.where("risk_category = 3").count()
    days = spark.read.csv(f"{folder}/csv/risk_over_time", header=True)
    assert days.count() == scored.select("date", "risk_category").distinct().count()


def test_a_backlog_is_scored_in_several_batches(spark, sf_dir, folder, capsys):
    rows = reports(spark, sf_dir).dropna(subset=["deaths"]).limit(900).repartition(6)
    model = jobs.train_on(
        rows.withColumns({"mois": F.month("date"), "jour": F.dayofmonth("date")})
    ).model
    learning.save(model, f"{folder}/model")
    write_message_files(rows, f"{folder}/messages")
    main(
        ["score", f"{folder}/model", "--folder", f"{folder}/messages", "--available-now",
         "--output", f"{folder}/scored", "--checkpoint", f"{folder}/checkpoint",
         "--max-bytes", "20000", "--rejected", f"{folder}/rejected"]
    )
    assert len(glob.glob(f"{folder}/scored/batch_id=*")) > 1
    assert spark.read.parquet(f"{folder}/scored").count() == 900
    assert spark.read.parquet(f"{folder}/rejected").count() == 0
    assert "'good'" in capsys.readouterr().out


def test_a_report_shows_all_states_and_whole_text(spark, folder, capsys):
    long = "County of " + "x" * 60
    data = [(f"State {i:02d}", long, f"2023-01-{i % 28 + 1:02d}", i % 5, 3) for i in range(50)]
    schema = "state STRING, county STRING, date STRING, risk_category INT, predicted_risk_category INT"
    spark.createDataFrame(data, schema).write.parquet(f"{folder}/scored")
    main(["report", "--predictions", f"{folder}/scored", "--state", "State 07"])
    out = capsys.readouterr().out
    assert long in out and out.count("High") > 20
    for question in ("category distribution", "actual vs predicted", "risk over time"):
        assert question in out


@pytest.mark.parametrize("absent", ["state", "county", "date", "risk_category", "predicted_risk_category"])
def test_a_report_without_a_column(spark, folder, capsys, absent):
    data = [("Texas", "c", "2023-02-30", 3, 3), ("Texas", "c", "2023-02-03", 4, 2)]
    whole = spark.createDataFrame(data, "state STRING, county STRING, date STRING, risk_category INT, predicted_risk_category INT")
    whole.drop(absent).write.parquet(f"{folder}/scored")
    main(["report", "--predictions", f"{folder}/scored", "--start", "2023-01-01", "--end", "2023-12-31"])
    out = capsys.readouterr().out
    assert ("risk over time" in out) == (absent not in ("date", "risk_category"))
    assert ("actual vs predicted" in out) == ("risk_category" not in absent)
    assert ("details" in out) == (absent not in ("state", "county", "date"))


def test_ingest_counts_and_sets_aside(spark, folder):
    with open(f"{folder}/raw.csv", "w") as out:
        out.write("date,county,state,cases,deaths\n")
        out.write("1/2/2023,c,S,5,1\n1/2/2023,c,S,7,1\nbad,c,S,5,1\n1/3/2023,d,S,oops,1\n")
        out.write("1/4/2023,e,S,-4,1\n1/5/2023,f,S,4,1\n")
    done = jobs.ingest(
        spark, f"{folder}/raw.csv", f"{folder}/out", keys=["annee"],
        quarantine_path=f"{folder}/bad", latest=True,
    )
    assert (done.rows, done.written_rows, done.quarantined_rows) == (6, 2, 3)
    assert (done.unparsed_dates, done.unreadable_lines) == (1, 1)
    bad = sorted(r.reason for r in spark.read.parquet(f"{folder}/bad").collect())
    assert bad == ["missing_count", "missing_key", "negative_count"]
    plain = jobs.ingest(spark, f"{folder}/raw.csv", f"{folder}/plain", keys=["annee"])
    assert (plain.rows, plain.written_rows, plain.quarantined_rows) == (6, 6, 0)
    with pytest.raises(ValueError):
        jobs.ingest(spark, f"{folder}/raw.csv", f"{folder}/x", latest=True)


def test_one_year_of_publishing(spark, sf_dir, folder):
    raw = reports(spark, sf_dir).select(
        F.date_format("date", "M/d/yyyy").alias("date"), "county", "state", "cases", "deaths"
    )
    raw.write.csv(f"{folder}/raw", header=True)
    main(["ingest", f"{folder}/raw", f"{folder}/curated", "--keys", "annee", "mois"])
    main(["publish", f"{folder}/curated", "--year", "2000", "--folder", f"{folder}/messages"])
    expected = reports(spark, sf_dir).where("year(date) = 2000 and deaths is not null").count()
    assert spark.read.text(f"{folder}/messages").count() == expected


def test_targets_must_be_named(spark, folder):
    with pytest.raises(SystemExit, match="--servers or --folder"):
        main(["publish", folder])
    with pytest.raises(SystemExit, match="jdbc"):
        main(["report"])
