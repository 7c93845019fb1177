"""Category counts that follow the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.dates import day_instant, day_of_instant


def live_distribution(
    stream: DataFrame,
    category: str = "risk_category",
    date: str = "date",
    lateness: str | None = None,
) -> DataFrame:
    """Rows per day and category, for the update and complete modes.

    Reports may come in any order of their days, so all days stay in the state by default; it
    has a row per day and category. With a lateness, state for a day is released once the
    watermark passes it, the append mode is possible, and later reports of that day are
    dropped; Spark counts them in numRowsDroppedByWatermark of the query's progress.

    Days are instants at UTC midnight, so the result does not depend on the session's time
    zone. Counts are combined per task before the shuffle and in the state store.
    """
    days = stream.where(F.col(category).isNotNull()).withColumn(
        "event_day", day_instant(F.col(date))
    )
    if lateness is not None:
        days = days.withWatermark("event_day", lateness)
    return (
        days.where(F.col("event_day").isNotNull())
        .groupBy(F.window("event_day", "1 day").alias("day_window"), category)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(day_of_instant(F.col("day_window.start")).alias("day"), category, "n")
    )


USABLE = "usable_reports"


def finished_days(
    stream: DataFrame, lateness: str, category: str = "risk_category", date: str = "date"
) -> DataFrame:
    """Rows per day and category, each given once, in append mode, when its day is over.

    A day is over when the watermark, the latest day so far less the lateness, has passed its
    end. State then lets it go, so the state holds the days within the lateness only, and reports
    that come for it later are left out. usable_rows, open_days and late_groups say how many.
    """
    day = day_instant(F.col(date))
    usable = stream.where(F.col(category).isNotNull() & day.isNotNull())
    counted = usable.observe(USABLE, F.count(F.lit(1)).alias("n"))
    return live_distribution(counted, category, date, lateness)


def usable_rows(query: StreamingQuery) -> dict[int, int]:
    """Reports that finished_days read, by batch, of the batches the query still remembers
    (spark.sql.streaming.numRecentProgressUpdates)."""
    return {
        p.batchId: p.observedMetrics[USABLE].n
        for p in query.recentProgress
        if USABLE in p.observedMetrics
    }


def late_groups(query: StreamingQuery) -> dict[int, int]:
    """What the watermark left out, by batch: pairs of day and category, not reports.

    Spark combines the reports of a batch before it compares them with the watermark, so its
    counter has one for all late reports of a day and category. The number of late reports is
    that of usable_rows less those in finished days and in open_days.
    """
    return {
        p.batchId: sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        for p in query.recentProgress
    }


def open_days(spark: SparkSession, checkpoint: str, category: str = "risk_category") -> DataFrame:
    """What the state behind finished_days holds after the last batch: day, category, n."""
    state = spark.read.format("statestore").load(checkpoint)
    window, kind = state.schema["key"].dataType.names
    (count,) = state.schema["value"].dataType.names
    return state.select(
        day_of_instant(F.col(f"key.{window}.start")).alias("day"),
        F.col(f"key.{kind}").alias(category),
        F.col(f"value.{count}").alias("n"),
    )
