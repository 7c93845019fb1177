"""Partitioned Parquet and CSV."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.constants import PARTITION_COLUMNS
from riskloom.sinks.paths import check_output


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = tuple(PARTITION_COLUMNS),
    inputs: Iterable[str] = (),
    touched_only: bool = False,
    sort: Sequence[str] = ("state",),
) -> None:
    """Overwrite a Parquet dataset laid out by keys; with touched_only just the folders df has.

    Rows are rebalanced by key before the write: small days share a task and give one file
    each, and a day above the advisory partition size is split between tasks and files. No
    global sort is needed; inside a file rows are sorted, which keeps row group ranges narrow.
    """
    check_output(path, inputs)
    order = [*keys, *[c for c in sort if c in df.columns]]
    balanced = df.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*order)
    writer = balanced.write.mode("overwrite").partitionBy(*keys)
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    writer.option("compression", "snappy").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A folder of UTF-8 CSV files, each with a header; null and empty text are both empty.

    Quotes inside a value are doubled.
    """
    df.write.mode("overwrite").csv(
        path,
        header=True,
        nullValue="",
        emptyValue="",
        quote='"',
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
