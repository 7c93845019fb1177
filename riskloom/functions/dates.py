"""Dates as text, dates as partitions, dates as event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.constants import CLOCK_FORMAT, ISO_DATE_FORMAT, RAW_DATE_FORMAT

SECONDS_PER_DAY = 86400


def parse_raw_date(text: Column) -> Column:
    """Date of a raw file such as 1/2/2023; null where the text is no date."""
    return F.try_to_date(text, RAW_DATE_FORMAT)


def parse_iso_date(text: Column) -> Column:
    """Date of a message such as 2023-01-02; null where the text is no date."""
    return F.try_to_date(text, ISO_DATE_FORMAT)


def with_date(df: DataFrame, column: str = "date") -> DataFrame:
    """The column as a date: text that is no ISO date becomes null, a time loses its clock."""
    if column not in df.columns or isinstance(df.schema[column].dataType, T.DateType):
        return df
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, parse_iso_date(F.col(column)))
    return df.withColumn(column, F.col(column).cast("date"))


def iso_text(date: Column) -> Column:
    return F.date_format(date, ISO_DATE_FORMAT)


def partition_parts(date: Column) -> dict[str, Column]:
    """Year, month and day as text; month and day zero-padded, so text order is time order."""
    return {
        "annee": F.year(date).cast("string"),
        "mois": F.lpad(F.month(date).cast("string"), 2, "0"),
        "jour": F.lpad(F.dayofmonth(date).cast("string"), 2, "0"),
    }


def clock_text() -> Column:
    return F.date_format(F.current_timestamp(), CLOCK_FORMAT)


def day_instant(date: Column) -> Column:
    """Start of the day as an instant that does not depend on the session time zone."""
    return F.timestamp_seconds(F.unix_date(F.to_date(date)).cast("long") * F.lit(SECONDS_PER_DAY))


def day_of_instant(instant: Column) -> Column:
    """Inverse of day_instant."""
    return F.date_from_unix_date(
        F.floor(F.unix_seconds(instant) / F.lit(SECONDS_PER_DAY)).cast("int")
    )
