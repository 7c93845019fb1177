"""Raw CSV files that arrive one after another, into the curated Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas
from riskloom.constants import PARTITION_COLUMNS
from riskloom.functions.dates import parse_raw_date, partition_parts
from riskloom.sinks.paths import check_output
from riskloom.sources.reports import UNREADABLE
from riskloom.streaming.sinks import start_files

ARRIVED = "arrived_reports"
BLOCK = "_block"


def arriving_reports(
    spark: SparkSession,
    folder: str,
    check_header: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The files of a folder as a stream, read as read_reports_csv reads them, each file once.

    A file is known by its path: one that is replaced under the same name is not read again.
    Unreadable lines are kept as text in a column of their own, and a number tells the block of
    the file that a row is from.
    """
    reader = spark.readStream.schema(f"{schemas.RAW_REPORT}, {UNREADABLE} STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(
        folder,
        header=True,
        enforceSchema=not check_header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=UNREADABLE,
    )
    block = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return rows.withColumn(BLOCK, block)


def start_ingest(
    raw: DataFrame,
    folder: str,
    output: str,
    checkpoint: str,
    keys: Sequence[str] = tuple(PARTITION_COLUMNS),
    spread: int = 16,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Append what arrives to the partitioned table, exactly once.

    Spark's file sink commits the files of a batch together, and a batch that comes again after
    a failure commits nothing new; read_reports reads committed files only. Rows of one
    partition folder go to at most spread tasks and files a batch, chosen by a hash of the
    report and its block, so neither a day with most rows nor copies of one row are one task, and
    a task computed again sends its rows the same way. All columns stay: which ones are sparse can
    be told of a whole table only. Dates that cannot be read are kept as null and counted.
    """
    check_output(output, [folder])
    date = parse_raw_date(F.col("date"))
    counted = raw.observe(
        ARRIVED,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNotNull() & date.isNull()).alias("unparsed_dates"),
        F.count_if(F.col(UNREADABLE).isNotNull()).alias("unreadable_lines"),
    )
    dated = counted.drop(UNREADABLE).withColumn("date", date)
    curated = dated.withColumns(partition_parts(F.col("date")))
    seat = F.pmod(F.xxhash64(*schemas.REPORT_COLUMNS, BLOCK), F.lit(spread))
    spread_out = curated.repartition(*[F.col(k) for k in keys], seat).drop(BLOCK)
    return start_files(spread_out, output, checkpoint, available_now, interval, keys)


def arrival_counts(query: StreamingQuery) -> dict[int, dict[str, int]]:
    """Rows, unreadable dates and lines of each batch that the query still remembers."""
    return {
        p.batchId: p.observedMetrics[ARRIVED].asDict()
        for p in query.recentProgress
        if ARRIVED in p.observedMetrics
    }
