"""Missing values, sparse columns, inconsistent and repeated reports."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import materialize

REPORT_KEY = ["state", "county", "date"]
REPORT_COUNTS = ["cases", "deaths"]

# Usable counts are integers from 0 to 2**31 - 1.
COUNT_BITS = 31
COUNT_RANGE = 1 << COUNT_BITS


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null or NaN in the given columns, all columns by default.

    One condition per column, which Catalyst can push down one by one, below joins and
    into the scan; dropna is a single condition over all columns and stays above them.
    """
    tests = []
    for name in df.columns if columns is None else columns:
        tests.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            tests.append(~F.isnan(name))
    return df.where(reduce(and_, tests)) if tests else df


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row: number of rows and the non-null count of every column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count(c).alias(c) for c in df.columns]
    )


@dataclass(frozen=True)
class FillReport:
    """What one pass over a table tells about it."""

    rows: int
    filled: dict[str, int]
    extra: dict[str, int]

    def sparse_columns(self, min_fill: float, keep: Iterable[str] = ()) -> list[str]:
        kept = set(keep)
        return [
            name
            for name, count in self.filled.items()
            if name not in kept and count < self.rows * min_fill
        ]


def measure_fill(df: DataFrame, **extra: Column) -> FillReport:
    """Row count, non-null counts and further counted conditions, all from one job.

    Only one row reaches the driver, whatever the size of the table.
    """
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.struct(*[F.count(c).alias(c) for c in df.columns]).alias("filled"),
        F.struct(
            F.lit(0).alias("none"), *[F.count_if(test).alias(n) for n, test in extra.items()]
        ).alias("extra"),
    ).first()
    extra_counts = row["extra"].asDict()
    extra_counts.pop("none")
    return FillReport(row["rows"], row["filled"].asDict(), extra_counts)


def drop_sparse_columns(
    df: DataFrame, min_fill: float = 0.5, keep: Iterable[str] = ()
) -> DataFrame:
    """Drop columns filled on less than min_fill of the rows.

    A column filled on exactly that share stays, and an empty table loses nothing.
    """
    return df.drop(*measure_fill(df).sparse_columns(min_fill, keep))


def fault(key: list[str] = REPORT_KEY, counts: list[str] = REPORT_COUNTS) -> Column:
    """Why a report is unusable: missing_key, missing_count, negative_count; null if usable."""
    return (
        F.when(reduce(or_, [F.col(c).isNull() for c in key]), "missing_key")
        .when(reduce(or_, [F.col(c).isNull() for c in counts]), "missing_count")
        .when(reduce(or_, [F.col(c) < 0 for c in counts]), "negative_count")
    )


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable reports, and the others with a reason; together they are all rows."""
    judged = df.withColumn("reason", fault())
    good = judged.where(F.col("reason").isNull()).drop("reason")
    bad = judged.where(F.col("reason").isNotNull())
    return good, bad


def latest_reports(good: DataFrame) -> DataFrame:
    """One report per state, county and date, of the usable reports that quarantine gives.

    Counts are cumulative, so the highest case count wins, then the highest death count. Both
    are packed into one long, whose maximum needs no sort: copies of a key shrink to one row
    per task in a hash aggregate before the shuffle, and no task ever holds a group.
    """
    packed = F.col("cases").cast("long") * F.lit(COUNT_RANGE) + F.col("deaths").cast("long")
    kept = good.groupBy(*REPORT_KEY).agg(
        F.max(packed).alias("best"), F.count(F.lit(1)).alias("copies")
    )
    return kept.select(
        *REPORT_KEY,
        F.shiftright("best", COUNT_BITS).cast("int").alias("cases"),
        F.pmod("best", F.lit(COUNT_RANGE)).cast("int").alias("deaths"),
        "copies",
    )


def with_previous(good: DataFrame) -> DataFrame:
    """Usable reports with the counts of the report before, per state and county in the order of
    date, cases and deaths: previous_cases, previous_deaths, null for a county's first report.

    Reports are sorted by range, so a county with very many lies in several tasks. Each looks
    back within its own range; the last report of a range is carried into the next one of the
    county, a row per county and range.
    """
    county = REPORT_KEY[:2]
    order = [*county, "date", *REPORT_COUNTS]
    ranged = good.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id()), "county-ranges")
    last = F.struct("date", *REPORT_COUNTS)
    ends = ranged.groupBy(*county, "part").agg(F.max(last).alias("end"))
    earlier = F.lag("end").over(Window.partitionBy(*county).orderBy("part"))
    carried = ends.withColumn("carried", earlier).drop("end").where("carried IS NOT NULL")
    back = Window.partitionBy(*county, "part").orderBy("date", *REPORT_COUNTS)
    joined = ranged.withColumn("before", F.lag(last).over(back)).join(
        carried, [*county, "part"], "left"
    )
    before = F.coalesce("before", "carried")
    return joined.select(
        *good.columns, *[before[c].alias(f"previous_{c}") for c in REPORT_COUNTS]
    )


def quarantine_falling(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of usable reports those whose counts do not fall, and the others with a reason.

    Counts are cumulative, so a report below the one before it in its county is inconsistent;
    which of the two is wrong is not known, and the later one is set aside.
    """
    known = with_previous(good)
    falls = reduce(
        or_, [F.coalesce(F.col(c) < F.col(f"previous_{c}"), F.lit(False)) for c in REPORT_COUNTS]
    )
    bad = known.where(falls).withColumn("reason", F.lit("falling_count"))
    return known.where(~falls).select(*good.columns), bad
