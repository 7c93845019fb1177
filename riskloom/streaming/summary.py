"""The dashboard's summary, kept up to date by the micro-batches of a stream.

A batch is reduced to its own summary, and only the months it touches are written anew: their
rows of the version before and those of the batch, added up. The work of a batch so follows the
batch and the states x days x categories of its months, not the predictions there are by now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.lookups import with_state_code
from riskloom.operators.report import SUMMARY_KEYS, WEIGHT, summarise
from riskloom.session import materialize
from riskloom.sinks.versions import (
    commit_version,
    latest_version,
    numbered,
    read_version,
    remove,
    remove_versions_before,
)
from riskloom.streaming.sinks import BatchWriter

SUMMARY = (
    "state STRING, date DATE, risk_category INT, predicted_risk_category INT, "
    f"{WEIGHT} LONG"
)
MONTH = "month"
ROWS = "rows"
UNDATED = "none"


def _folders(path: str, months: dict[str, int], chosen: list[str] | None = None) -> list[str]:
    names = months if chosen is None else [m for m in chosen if m in months]
    return [f"{path}/{ROWS}={months[m]}/{MONTH}={m}" for m in names]


def _rows(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], SUMMARY)
    return spark.read.schema(SUMMARY).parquet(*folders)


def summary_batches(path: str, keep: int = 3) -> BatchWriter:
    """Add every micro-batch of predictions to the summary at path, each once.

    A version names the stream, its last batch and the folder of every month. A batch that comes
    again is in the version already and changes nothing; one that broke off left no version and
    is added anew. Another stream is refused, since its batches have the same numbers. The last
    versions stay for readers that have opened them; older ones and their folders are removed.
    Months are collected to name their folders: as many as the calendar has.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")

    def write(batch: DataFrame, batch_id: int, stream: str) -> bool:
        spark = batch.sparkSession
        number, last = latest_version(spark, path) or (
            -1,
            {"stream": stream, "batch": -1, "months": {}},
        )
        if last["stream"] != stream:
            raise ValueError(f"{path} follows stream {last['stream']}, not {stream}")
        if batch_id <= last["batch"]:
            return False
        number += 1
        month = F.coalesce(F.date_format("date", "yyyy-MM"), F.lit(UNDATED))
        counts = summarise(batch).select(*SUMMARY_KEYS, WEIGHT)
        added = materialize(counts.withColumn(MONTH, month), "summary-batch")
        touched = [row[0] for row in added.select(MONTH).distinct().collect()]
        if touched:
            before = _rows(spark, _folders(path, last["months"], touched))
            both = before.withColumn(MONTH, month).unionByName(added)
            merged = both.groupBy(MONTH, *SUMMARY_KEYS).agg(F.sum(WEIGHT).alias(WEIGHT))
            balanced = merged.hint("rebalance", F.col(MONTH))
            balanced.write.mode("overwrite").partitionBy(MONTH).option(
                "partitionOverwriteMode", "static"
            ).parquet(f"{path}/{ROWS}={number}")
        months = {**last["months"], **dict.fromkeys(touched, number)}
        commit_version(
            spark, path, number, {"stream": stream, "batch": batch_id, "months": months}
        )
        _forget(spark, path, number - keep + 1)
        return True

    return write


def _forget(spark: SparkSession, path: str, oldest: int) -> None:
    """Remove the versions before the oldest one kept, and folders that no kept one names."""
    kept = [n for n in numbered(spark, path, "version") if n >= oldest]
    used = {f for n in kept for f in read_version(spark, path, n)["months"].values()}
    remove_versions_before(spark, path, oldest)
    for folder in numbered(spark, path, ROWS, whole=False):
        if folder not in used and folder <= kept[-1]:
            remove(spark, f"{path}/{ROWS}={folder}")


def read_summary(
    spark: SparkSession, path: str, codes: DataFrame | None = None
) -> DataFrame:
    """The summary as of the last batch, as summarise gives it; empty before the first one."""
    found = latest_version(spark, path)
    folders = _folders(path, found[1]["months"]) if found else []
    return with_state_code(_rows(spark, folders), codes)
