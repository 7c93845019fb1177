from __future__ import annotations

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskloom.functions.dates import parse_iso_date, parse_raw_date, partition_parts
from riskloom.plans.jobs import ingest
from riskloom.session import shared_folder
from riskloom.sinks.files import export_csv, write_partitioned
from riskloom.sinks.messages import publish_reports, to_messages
from riskloom.sinks.paths import check_output
from riskloom.sources.reports import read_reports, read_reports_csv, union_feeds
from riskloom.streaming.scoring import decode_reports


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
    return path


CSV = """date,county,state,cases,deaths
1/2/2023,x,A,5,1
12/31/2023,y,A,oops,
bad,z,B,7,2
,z,B,8,2
2/29/2024,"q, r",B,9,0
"""


def test_csv_scan(spark, folder):
    df = read_reports_csv(spark, put(folder, "in.csv", CSV))
    rows = df.collect()
    assert [(r.cases, r.deaths) for r in rows] == [(5, 1), (None, None), (7, 2), (8, 2), (9, 0)]
    assert rows[4].county == "q, r"


def test_csv_header_in_another_order(spark, folder):
    path = put(folder, "in.csv", "date,county,state,deaths,cases\n1/2/2023,x,A,1,5\n")
    with pytest.raises(Exception, match="header"):
        read_reports_csv(spark, path).collect()
    loose = read_reports_csv(spark, path, check_header=False).first()
    assert (loose.cases, loose.deaths) == (1, 5)


def test_dates(spark):
    df = spark.createDataFrame([("1/2/2023",), ("12/31/2023",), ("bad",), (None,)], "t STRING")
    assert [r[0] for r in df.select(parse_raw_date(F.col("t"))).collect()] == [
        dt.date(2023, 1, 2), dt.date(2023, 12, 31), None, None
    ]
    iso = spark.createDataFrame([("2023-01-02",), ("2023-13-02",), ("1/2/2023",)], "t STRING")
    assert [r[0] for r in iso.select(parse_iso_date(F.col("t"))).collect()] == [
        dt.date(2023, 1, 2), None, None
    ]


def test_partition_parts(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 2),), (None,)], "d DATE")
    rows = df.select(*[p.alias(n) for n, p in partition_parts(F.col("d")).items()]).collect()
    assert [tuple(r) for r in rows] == [("2023", "01", "02"), (None, None, None)]


def test_ingest(spark, folder):
    path = put(f"{folder}/raw", "in.csv", CSV)
    done = ingest(spark, path, f"{folder}/out")
    assert (done.rows, done.columns, done.dropped_columns, done.unparsed_dates) == (5, 8, [], 1)
    assert os.path.isdir(f"{folder}/out/annee=2023/mois=01/jour=02")
    assert os.path.isdir(f"{folder}/out/annee=2024/mois=02/jour=29")
    rows = read_reports(spark, f"{folder}/out").collect()
    assert len(rows) == 5
    assert sum(r.date is None for r in rows) == 2
    assert {(r.mois, r.jour) for r in rows if r.date} == {(1, 2), (12, 31), (2, 29)}
    assert read_reports(spark, f"{folder}/out", year=2023).count() == 2
    assert read_reports(spark, f"{folder}/out/annee=2023").count() == 2


def test_ingest_drops_a_sparse_column_and_protects_the_date(spark, folder):
    text = "date,county,state,cases,deaths\n" + ",x,A,1,\n" * 3 + "1/2/2023,x,A,1,1\n"
    done = ingest(spark, put(f"{folder}/raw", "in.csv", text), f"{folder}/out")
    assert done.dropped_columns == ["deaths"]
    assert "date" in spark.read.parquet(f"{folder}/out").columns


def test_year_restriction_prunes_folders(spark, folder, plan_of):
    ingest(spark, put(f"{folder}/raw", "in.csv", CSV), f"{folder}/out", keys=["annee", "mois"])
    df = read_reports(spark, f"{folder}/out", year=2024)
    assert [tuple(r) for r in df.select("county", "mois", "jour").collect()] == [("q, r", 2, 29)]
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(annee" in plan


def test_folders_read_as_text(spark, folder):
    ingest(spark, put(f"{folder}/raw", "in.csv", CSV), f"{folder}/out")
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(setting, "false")
    try:
        (row,) = read_reports(spark, f"{folder}/out", year=2024).collect()
    finally:
        spark.conf.unset(setting)
    assert (row.county, row.mois, row.jour) == ("q, r", 2, 29)


def days(spark, rows, start="2023-01-01", hot=False):
    offset = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7) if hot else F.col("id") % 7
    df = spark.range(0, rows, 1, 8).select(
        F.date_add(F.lit(start).cast("date"), offset.cast("int")).alias("date"),
        F.concat(F.lit("county"), "id").alias("county"),
        F.lit("A").alias("state"),
        F.col("id").cast("int").alias("cases"),
        F.lit(1).alias("deaths"),
    )
    return df.withColumns(partition_parts(F.col("date")))


def files_of(path):
    return glob.glob(f"{path}/*/*/*/*.parquet")


def test_small_days_give_one_file_each(spark, folder):
    write_partitioned(days(spark, 700), folder + "/out")
    assert len(files_of(folder + "/out")) == 7


def test_a_hot_day_is_split_between_files(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        df = days(spark, 100_000, hot=True)
        write_partitioned(df, folder + "/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(folder + "/out/annee=2023/mois=01/jour=01/*.parquet")) > 1
    back = spark.read.parquet(folder + "/out")
    columns = ["date", "county", "state", "cases", "deaths"]
    assert back.select(columns).exceptAll(df.select(columns)).isEmpty()
    assert back.count() == 100_000


def test_touched_only_keeps_other_days(spark, folder):
    write_partitioned(days(spark, 70), folder + "/out")
    write_partitioned(days(spark, 7, start="2023-01-05"), folder + "/out", touched_only=True)
    assert spark.read.parquet(folder + "/out").count() == 4 * 10 + 7
    write_partitioned(days(spark, 7), folder + "/out")
    assert spark.read.parquet(folder + "/out").count() == 7


@pytest.mark.parametrize(
    "output,source",
    [
        ("/data/p", "/data/p"),
        ("/data/p/", "/data/p"),
        ("/data/p", "/data/p/in.csv"),
        ("/data", "/data/p/in.csv"),
        ("/data/p/out", "/data/p"),
        ("hdfs://host:9000/data/p", "hdfs://host:9000/data/p/*.csv"),
        ("hdfs://a:9000/data", "hdfs://b:8020/data"),
        ("file:/data/p", "/data/p/in.csv"),
        ("file:///data", "/data/p/in.csv"),
        ("/data/x/../p", "/data/p/in.csv"),
        ("data/raw", f"{os.getcwd()}/data/raw/x.csv"),
        (f"{os.getcwd()}/data", "data/raw/*.csv"),
        (".", "raw.csv"),
    ],
)
def test_overlapping_paths_are_refused(spark, output, source):
    with pytest.raises(ValueError, match="overlaps"):
        check_output(output, [source])


@pytest.mark.parametrize(
    "output,source",
    [
        ("/data/curated", "/data/raw/in.csv"),
        ("/data/p2", "/data/p"),
        ("hdfs://a:9000/data", "/data/in.csv"),
        ("/data/p/out", "/data/p/in.csv"),
        ("data/out", "data/raw/*.csv"),
        ("/data/out", "data/out"),
    ],
)
def test_separate_paths_are_allowed(spark, output, source):
    check_output(output, [source])


def test_ingest_into_the_input_folder_is_refused_before_anything_is_written(spark, folder):
    path = put(f"{folder}/p", "in.csv", CSV)
    with pytest.raises(ValueError):
        ingest(spark, path, f"{folder}/p")
    assert os.path.exists(path)


def test_export_csv_text(spark, folder):
    df = spark.createDataFrame(
        [("A", 'say "hi", all', dt.date(2023, 1, 2), None), ("B", "", None, "Löw")],
        "State STRING, County STRING, Date DATE, `Risk Category` STRING",
    ).coalesce(1)
    export_csv(df, folder + "/out")
    (name,) = glob.glob(folder + "/out/*.csv")
    with open(name, encoding="utf-8") as text:
        assert text.read().splitlines() == [
            "State,County,Date,Risk Category",
            'A,"say ""hi"", all",2023-01-02,',
            "B,,,Löw",
        ]


def test_messages(spark):
    df = spark.createDataFrame(
        [("A", "x", dt.date(2023, 1, 2), 5, 1), ("A", "x", None, 5, 1), ("A", "x", dt.date(2023, 1, 2), None, 1)],
        "state STRING, county STRING, date DATE, cases INT, deaths INT",
    )
    assert [r.value for r in to_messages(df).collect()] == [
        '{"state":"A","county":"x","date":"2023-01-02","cases":5,"deaths":1,"mois":1,"jour":2}'
    ]


def test_publishing_needs_the_kafka_connector(spark):
    df = spark.createDataFrame(
        [("A", "x", dt.date(2023, 1, 2), 5, 1)],
        "state STRING, county STRING, date DATE, cases INT, deaths INT",
    )
    with pytest.raises(AnalysisException, match="kafka"):
        publish_reports(df, "nowhere:9092")


BODIES = [
    '{"state":"A","county":"x","date":"2023-01-02","cases":5,"deaths":1,"mois":1,"jour":2}',
    '{"state":"A"}',
    "nope",
    '{"state":"A","cases":"5","deaths":5.5,"mois":3000000000}',
    None,
]


@pytest.mark.parametrize("binary", [False, True])
def test_decoding(spark, binary):
    df = spark.createDataFrame([(b,) for b in BODIES], "value STRING")
    if binary:
        df = df.withColumn("value", F.col("value").cast("binary"))
    rows = [tuple(r) for r in decode_reports(df).collect()]
    assert rows[0] == ("A", "x", "2023-01-02", 5, 1, 1, 2)
    assert rows[1] == ("A", None, None, None, None, None, None)
    assert rows[2] == (None,) * 7
    assert rows[3] == ("A", None, None, None, None, None, None)
    assert rows[4] == (None,) * 7


def test_union_of_feeds(spark):
    a = spark.createDataFrame([("A", 1, 2)], "state STRING, cases INT, deaths INT")
    b = spark.createDataFrame([(3, "B")], "cases INT, state STRING")
    c = spark.createDataFrame([("C", "n")], "state STRING, note STRING")
    rows = {r.source: r for r in union_feeds({"a": a, "b": b, "c": c}).collect()}
    assert (rows["b"].state, rows["b"].cases, rows["b"].deaths) == ("B", 3, None)
    assert (rows["c"].note, rows["c"].cases) == ("n", None)


def test_shared_folder_follows_the_session(spark):
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert first.startswith(named.rstrip("/") if named else tempfile.gettempdir())
    assert first != second


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    class Conf:
        def get(self, key, default):
            return {"spark.master": master}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def test_ingest_of_several_files(spark, folder):
    paths = [
        put(f"{folder}/raw", f"{i}.csv", f"date,county,state,cases,deaths\n1/{i}/2023,x,A,{i},0\n")
        for i in (1, 2, 3)
    ]
    assert ingest(spark, paths[:2], f"{folder}/out").rows == 2
    assert read_reports(spark, f"{folder}/out").count() == 2
    with pytest.raises(ValueError):
        ingest(spark, [paths[0], f"{folder}/out/annee=2023"], f"{folder}/out")
    assert read_reports(spark, f"{folder}/out").count() == 2
