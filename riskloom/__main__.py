"""Command line of the jobs, for spark-submit: ingest, train, publish, score, report."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom.constants import PARTITION_COLUMNS, REPORTS_TOPIC
from riskloom.operators import learning
from riskloom.plans import jobs
from riskloom.session import build_session
from riskloom.sinks.files import export_csv
from riskloom.sinks.messages import publish_reports, write_message_files
from riskloom.sources.jdbc import JdbcTable
from riskloom.sources.reports import read_reports
from riskloom.streaming.sinks import jdbc_batches, parquet_batches, read_batches
from riskloom.streaming.sources import file_messages, kafka_messages

# What one micro-batch may hold, and how many tasks may write to the database at once.
MAX_OFFSETS = 1_000_000
MAX_BYTES = 1 << 30
CONNECTIONS = 8

LONGEST_TABLE = 1000

JDBC_HINT = "the table named by the spark.riskloom.jdbc.* settings"


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="riskloom")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="raw CSV to partitioned Parquet")
    ingest.add_argument("input")
    ingest.add_argument("output")
    ingest.add_argument("--keys", nargs="+", default=PARTITION_COLUMNS, choices=PARTITION_COLUMNS)
    ingest.add_argument("--touched-only", action="store_true")
    ingest.add_argument("--quarantine", help="folder for unusable reports and their reasons")
    ingest.add_argument("--latest", action="store_true", help="one report per county and day")

    train = commands.add_parser("train", help="fit, evaluate and save a model")
    train.add_argument("reports")
    train.add_argument("model")
    train.add_argument("--year", type=int)
    train.add_argument("--kind", default="forest", choices=["forest", "logistic", "svm"])

    publish = commands.add_parser("publish", help="send reports as messages")
    publish.add_argument("reports")
    publish.add_argument("--year", type=int)
    publish.add_argument("--servers", help="Kafka brokers")
    publish.add_argument("--topic", default=REPORTS_TOPIC)
    publish.add_argument("--folder", help="write text files there instead")

    score = commands.add_parser("score", help="score messages as they come")
    score.add_argument("model")
    score.add_argument("--servers", help="Kafka brokers")
    score.add_argument("--topic", default=REPORTS_TOPIC)
    score.add_argument("--starting-offsets", default="earliest")
    score.add_argument("--folder", help="read text files there instead")
    score.add_argument("--output", help=f"folder of the predictions; default: {JDBC_HINT}")
    score.add_argument("--checkpoint", required=True)
    score.add_argument("--available-now", action="store_true", help="stop after what is there")
    score.add_argument("--interval", help="time between micro-batches, such as '1 minute'")
    score.add_argument("--rejected", help="folder for messages that give no prediction")
    score.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="per micro-batch")
    score.add_argument("--max-bytes", type=int, default=MAX_BYTES, help="per micro-batch, files")
    score.add_argument("--max-files", type=int, help="per micro-batch, instead of bytes")
    score.add_argument("--min-partitions", type=int, help="tasks that share the topic")
    score.add_argument("--allow-data-loss", action="store_true", help="go on if offsets are gone")
    score.add_argument("--connections", type=int, default=CONNECTIONS, help="to the database")

    view = commands.add_parser("report", help="show the dashboard's answers, export the details")
    view.add_argument("--predictions", help=f"folder of the predictions; default: {JDBC_HINT}")
    view.add_argument("--state")
    view.add_argument("--risk")
    view.add_argument("--start")
    view.add_argument("--end")
    view.add_argument("--export", help="folder for the details and the daily series as CSV")
    return parser


def _jdbc(spark: SparkSession) -> JdbcTable:
    table = JdbcTable.from_settings(spark)
    if table is None:
        raise SystemExit("name a folder, or set spark.riskloom.jdbc.url")
    return table


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.folder:
        by_bytes = None if args.max_files else args.max_bytes
        return file_messages(spark, args.folder, args.max_files, by_bytes)
    return kafka_messages(
        spark,
        args.servers,
        args.topic,
        args.starting_offsets,
        fail_on_data_loss=not args.allow_data_loss,
        min_partitions=args.min_partitions,
        max_offsets_per_trigger=args.max_offsets,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    if args.command in ("publish", "score") and not (args.folder or args.servers):
        raise SystemExit("name --servers or --folder")
    spark = build_session(f"riskloom-{args.command}")
    if args.command == "ingest":
        done = jobs.ingest(
            spark,
            args.input,
            args.output,
            keys=args.keys,
            touched_only=args.touched_only,
            quarantine_path=args.quarantine,
            latest=args.latest,
        )
        print(done)
    elif args.command == "train":
        jobs.train(spark, args.reports, args.model, args.year, args.kind).quality().show()
    elif args.command == "publish":
        rows = read_reports(spark, args.reports, args.year)
        if args.folder:
            write_message_files(rows, args.folder)
        else:
            publish_reports(rows, args.servers, args.topic)
    elif args.command == "score":
        if args.output:
            write = parquet_batches(args.output)
        else:
            write = jdbc_batches(_jdbc(spark), numPartitions=str(args.connections))
        jobs.score_stream(
            _messages(spark, args),
            learning.load(spark, args.model),
            write,
            args.checkpoint,
            args.available_now,
            args.interval,
            parquet_batches(args.rejected) if args.rejected else None,
            lambda batch_id, counts: print(f"batch {batch_id}: {counts}"),
        ).awaitTermination()
    else:
        if args.predictions:
            board = jobs.open_dashboard(read_batches(spark, args.predictions))
        else:
            board = jobs.open_jdbc_dashboard(spark, _jdbc(spark))
        show_report(board, args)


def _print(title: str, rows: DataFrame) -> bool:
    """A table whole and untruncated, if it is not longer than a reader would read; else true."""
    print(title)
    count = rows.count()
    rows.show(min(count, LONGEST_TABLE), truncate=False)
    if count > LONGEST_TABLE:
        print(f"the first {LONGEST_TABLE} of {count} rows; --export writes all of them")
    return count > LONGEST_TABLE


def show_report(board: jobs.Dashboard, args: argparse.Namespace) -> None:
    """Every answer that the columns at hand allow."""
    if board.is_empty():
        print("no predictions")
        return
    can = board.available()
    for question in (
        "category_distribution",
        "actual_vs_predicted",
        "risk_over_time",
        "mean_risk_by_state",
        "top_high_risk_states",
        "filter_options",
    ):
        if question in can:
            rows = getattr(board, question)()
            cut = _print(question.replace("_", " "), rows)
            if args.export and (cut or question == "risk_over_time"):
                export_csv(rows, f"{args.export}/{question}")
    if "details" in can:
        details = board.details(state=args.state, risk=args.risk, start=args.start, end=args.end)
        _print("details", details)
        if args.export:
            export_csv(details, f"{args.export}/details")
    board.close()


if __name__ == "__main__":
    main()
