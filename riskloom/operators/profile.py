"""Exploratory statistics."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Size of a distinct-count sketch; its error is 1.04 / sqrt(2**LG_K), here 0.8 percent.
LG_K = 14
SKETCH_ERROR = 1.04 / 2 ** (LG_K / 2)

QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per numeric column: counts, range, mean and deviation, all from one pass."""
    names = numeric_columns(df) if columns is None else columns

    def measures(name: str):
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count(name).alias("filled_rows"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.round(F.avg(value), 6).alias("mean_value"),
            F.round(F.stddev(value), 6).alias("stddev_value"),
        )

    return df.agg(F.array(*[measures(n) for n in names]).alias("m")).select(F.inline("m"))


def quantiles(
    df: DataFrame, columns: list[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """One row per numeric column: quartiles, off by at most rows / accuracy ranks.

    The sketch of a task has bounded size, which exact percentiles do not.
    """
    names = numeric_columns(df) if columns is None else columns

    def measures(name: str):
        points = F.percentile_approx(name, list(QUANTILES.values()), accuracy)
        return F.struct(
            F.lit(name).alias("column_name"),
            *[points[i].cast("double").alias(q) for i, q in enumerate(QUANTILES)],
        )

    return df.agg(F.array(*[measures(n) for n in names]).alias("m")).select(F.inline("m"))


def quantile_ranks(
    df: DataFrame, columns: list[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """One row per column and quartile: whether its rank is within the error of quantiles().

    Two passes: the few quartiles are constants of the second.
    """
    found = quantiles(df, columns, accuracy).collect()

    def measure(name: str, point: str, value: float | None):
        column, n = F.col(name), F.count(name)
        share, slack = QUANTILES[point], n / accuracy + 1
        below, to = F.count_if(column < value), F.count_if(column <= value)
        inside = (below <= share * n + slack) & (to >= share * n - slack)
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(point).alias("quantile"),
            (F.lit(True) if value is None else inside).alias("within"),
        )

    rows = [measure(r["column_name"], q, r[q]) for r in found for q in QUANTILES]
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row per pair of columns: Pearson correlation over rows that have both."""

    def measure(left: str, right: str):
        return F.struct(
            F.lit(left).alias("left_column"),
            F.lit(right).alias("right_column"),
            F.round(F.corr(left, right), 6).alias("correlation"),
        )

    return df.agg(F.array(*[measure(*p) for p in pairs]).alias("m")).select(F.inline("m"))


def distinct_sketches(
    df: DataFrame, columns: list[str], by: list[str] | None = None
) -> DataFrame:
    """column_name, filled_rows, sketch per group (or of all rows): what distinct_counts reads.

    A sketch has bounded size and is combined per task before the shuffle, where an exact count
    would send every distinct value. Sketches merge: those of single days or states, kept in a
    table, give the counts of any set of them without reading the reports again.
    """

    def measure(name: str):
        text = F.col(name).cast("string")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(name).alias("filled_rows"),
            F.hll_sketch_agg(text, F.lit(LG_K)).alias("sketch"),
        )

    groups = list(by or [])
    measured = df.groupBy(*groups).agg(F.array(*[measure(c) for c in columns]).alias("m"))
    return measured.select(*groups, F.inline("m"))


def distinct_counts(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """column_name, filled_rows, distinct_values and its bounds, three errors to each side."""
    found = sketches.groupBy(*(by or []), "column_name").agg(
        F.sum("filled_rows").alias("filled_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("distinct_values"),
    )
    slack = F.ceil(F.col("distinct_values") * F.lit(3 * SKETCH_ERROR)).cast("long")
    return found.withColumn(
        "at_least", F.greatest(F.col("distinct_values") - slack, F.lit(0))
    ).withColumn("at_most", F.col("distinct_values") + slack)


def frequent_values(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """column_name, value (text), n: every value that fills more than this share of all rows.

    The first pass keeps a bounded sketch of frequent items per column, whose candidates are at
    most 1 / share and surely hold each value above the share: a count is off by less than half
    the threshold. The second counts the candidates exactly. No pass shuffles the values.
    """
    if not 0 < share < 1:
        raise ValueError("share has to lie between 0 and 1")
    most = ceil(2 / share)
    tracked = 1 << max(3, ceil(log2(16 / share)))
    tops = [
        F.expr(f"approx_top_k(CAST(`{name}` AS STRING), {most}, {tracked})").alias(f"c{i}")
        for i, name in enumerate(columns)
    ]
    first = df.agg(F.count(F.lit(1)).alias("rows"), *tops).first()

    def counted(i: int, name: str) -> Column:
        values = sorted({item["item"] for item in first[f"c{i}"] or [] if item["item"] is not None})
        text = F.col(name).cast("string")
        return F.filter(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.lit(v).alias("value"),
                        F.count_if(text == F.lit(v)).alias("n"),
                    )
                    for v in values
                ]
            ).cast("array<struct<column_name:string,value:string,n:bigint>>"),
            lambda x: x["n"] > F.lit(share) * F.lit(first["rows"]),
        )

    found = df.agg(F.concat(*[counted(i, c) for i, c in enumerate(columns)]).alias("m"))
    return found.select(F.inline("m"))
