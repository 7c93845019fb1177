"""Predictions appended to a relational table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.copies import rows_beyond
from riskloom.sources.jdbc import (
    BATCH_COLUMN,
    DELIVERY_COLUMN,
    ROW_COLUMN,
    SPREAD_COLUMN,
    SPREAD_VALUES,
    STREAM_COLUMN,
    JdbcTable,
    without_repeats,
)

STATE_COLUMN = "state"
STARTED, DONE = "started", "done"
TYPES = "createTableColumnTypes"
LEDGER = f"{STREAM_COLUMN} STRING, {BATCH_COLUMN} LONG, {STATE_COLUMN} STRING"
LEDGER_TYPES = f"{STREAM_COLUMN} VARCHAR(64), {STATE_COLUMN} VARCHAR(16)"


def write_jdbc(df: DataFrame, target: JdbcTable, mode: str = "append", **options: str) -> None:
    """Plain append; numPartitions among the options bounds the number of connections."""
    df.write.format("jdbc").option("url", target.url).option("dbtable", target.table).options(
        **target.options
    ).options(**options).mode(mode).save()


def append_batch_jdbc(
    df: DataFrame, target: JdbcTable, batch_id: int, stream: str, **options: str
) -> bool:
    """Append a micro-batch so that neither a replay nor a repeated task changes what is read.

    A small ledger beside the table says which batches of which stream were started and which
    are done, so the table itself is not searched. A batch that is done is not written again.
    One that was started but not done writes only the rows the table lacks for it, counted
    with copies. Inside a delivery every row has a number, by which read_predictions tells
    rows that a task wrote twice from rows that are equal. Returns whether it wrote.
    """
    spark = df.sparkSession
    types = [options.get(TYPES, ""), f"{STREAM_COLUMN} VARCHAR(64)"]
    options[TYPES] = ", ".join(t for t in types if t)
    ledger = target.beside("batches")
    states = _states(spark, ledger, batch_id, stream)
    if DONE in states:
        return False
    missing = df
    if STARTED in states:
        stored = target.scan(spark, **_split(options)).where(
            (F.col(BATCH_COLUMN) == batch_id) & (F.col(STREAM_COLUMN) == stream)
        )
        missing = rows_beyond(df, without_repeats(stored, df.columns))
    else:
        # Writing no rows first creates the table where there is none.
        no_rows = spark.createDataFrame([], df.schema)
        write_jdbc(_tagged(no_rows, batch_id, stream), target, **options)
        _note(spark, ledger, batch_id, stream, STARTED)
    write_jdbc(_tagged(missing, batch_id, stream), target, **options)
    _note(spark, ledger, batch_id, stream, DONE)
    return True


def _split(options: dict[str, str]) -> dict[str, str]:
    """What lets several tasks read a batch back."""
    return {
        "partitionColumn": SPREAD_COLUMN,
        "lowerBound": "0",
        "upperBound": str(SPREAD_VALUES),
        "numPartitions": options.get("numPartitions", "16"),
    }


def _note(spark: SparkSession, ledger: JdbcTable, batch_id: int, stream: str, state: str) -> None:
    row = spark.createDataFrame([(stream, int(batch_id), state)], LEDGER).coalesce(1)
    write_jdbc(row, ledger, createTableColumnTypes=LEDGER_TYPES)


def _states(spark: SparkSession, ledger: JdbcTable, batch_id: int, stream: str) -> set[str]:
    """At most a few rows: what the ledger holds for this batch."""
    write_jdbc(spark.createDataFrame([], LEDGER), ledger, createTableColumnTypes=LEDGER_TYPES)
    rows = ledger.scan(spark).where(
        (F.col(BATCH_COLUMN) == batch_id) & (F.col(STREAM_COLUMN) == stream)
    )
    return {r[0] for r in rows.select(STATE_COLUMN).distinct().collect()}


def _tagged(df: DataFrame, batch_id: int, stream: str) -> DataFrame:
    """Sorted inside each partition, so that a task that runs again numbers rows the same way."""
    return df.sortWithinPartitions(*df.columns).withColumns(
        {
            STREAM_COLUMN: F.lit(stream),
            BATCH_COLUMN: F.lit(batch_id).cast("long"),
            DELIVERY_COLUMN: F.lit(uuid.uuid4().int >> 65).cast("long"),
            ROW_COLUMN: F.monotonically_increasing_id(),
            SPREAD_COLUMN: F.floor(F.rand() * SPREAD_VALUES).cast("int"),
        }
    )
