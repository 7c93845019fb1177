"""Difference of tables whose rows may repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_ROW = 10_000


def rows_beyond(df: DataFrame, other: DataFrame, step: int = COPIES_PER_ROW) -> DataFrame:
    """The rows of df that other lacks, counted with copies; null equals null.

    Copies are counted per task before the shuffle. What is owed is written out again in steps
    that are spread over the tasks, so a row with many copies does not come from one task.
    """
    columns = df.columns
    signed = df.withColumn("owed", F.lit(1)).unionByName(other.withColumn("owed", F.lit(-1)))
    owed = signed.groupBy(*columns).agg(F.sum("owed").alias("owed")).where(F.col("owed") > 0)
    zero, one, many = (F.lit(n).cast("long") for n in (0, 1, step))
    starts = F.explode(F.sequence(zero, F.col("owed") - one, many))
    spread = owed.withColumn("start", starts).repartition(*columns, "start")
    copies = F.least(many, F.col("owed") - F.col("start"))
    return spread.withColumn("copy", F.explode(F.sequence(one, copies))).select(columns)
