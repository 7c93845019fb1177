"""The questions a risk dashboard asks of the predictions.

Every aggregate takes either the predictions themselves or the much smaller table made by
summarise, which carries the number of predictions behind each of its rows. All group
counts are combined per task before the shuffle, so a hot state, day or category costs
one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import HIGH_RISK_CODE, NO_FILTER
from riskloom.functions.dates import clock_text, with_date
from riskloom.functions.risk import category_label, code_of_label
from riskloom.operators.cleaning import drop_incomplete
from riskloom.operators.lookups import one_code_per_state, with_state_code
from riskloom.operators.scoring import with_labels

WEIGHT = "report_rows"
SUMMARY_KEYS = ["state", "date", "risk_category", "predicted_risk_category"]


def enrich_predictions(
    df: DataFrame, codes: DataFrame | None = None, loaded_at: str | None = None
) -> DataFrame:
    """Add load time, category labels and state code."""
    stamp = clock_text() if loaded_at is None else F.lit(loaded_at)
    labelled = with_labels(with_date(df).withColumn("timestamp", stamp))
    return with_state_code(labelled, codes) if "state" in df.columns else labelled


def summarise(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Number of predictions per state, day, category and predicted category.

    Its size follows the number of states and days, not the number of predictions, and
    all counts and means below can be computed from it exactly. State codes are looked up
    for these few rows, not for the predictions.
    """
    keys = [c for c in SUMMARY_KEYS if c in df.columns]
    counts = df.groupBy(*keys).agg(_rows(df).alias(WEIGHT))
    return with_state_code(counts, codes) if "state" in keys else counts


def _rows(df: DataFrame, test: Column | None = None) -> Column:
    if WEIGHT in df.columns:
        return F.sum(F.col(WEIGHT) if test is None else F.when(test, F.col(WEIGHT)))
    return F.count(F.lit(1) if test is None else F.when(test, F.lit(1)))


def _mean(df: DataFrame, column: str) -> Column:
    if WEIGHT in df.columns:
        total = F.sum(F.col(column) * F.col(WEIGHT))
        return total / _rows(df, F.col(column).isNotNull())
    return F.avg(column)


def _labelled(df: DataFrame, *extra_keys: str) -> DataFrame:
    """Counts per label and extra keys, null labels and keys left out.

    Groups by the integer code where there is one and labels the few groups afterwards.
    """
    key = "risk_category" if "risk_category" in df.columns else "risk_category_text"
    counts = df.groupBy(*extra_keys, key).agg(_rows(df).alias("n"))
    if key == "risk_category":
        counts = counts.withColumn("risk_category_text", category_label(F.col(key))).drop(key)
    return drop_incomplete(counts, [*extra_keys, "risk_category_text"])


def category_distribution(df: DataFrame) -> DataFrame:
    """Predictions per category label, most frequent first."""
    return _labelled(df).orderBy(F.desc("n"), "risk_category_text")


def actual_vs_predicted(df: DataFrame) -> DataFrame:
    """Predictions per observed pair of actual and predicted category."""
    pair = ["risk_category", "predicted_risk_category"]
    return drop_incomplete(df, pair).groupBy(*pair).agg(_rows(df).alias("n")).orderBy(*pair)


def confusion_matrix(df: DataFrame) -> DataFrame:
    """The same counts with one column per predicted category, 0 for pairs never seen."""
    cells = [
        F.coalesce(
            _rows(df, F.col("predicted_risk_category") == code), F.lit(0).cast("long")
        ).alias(f"predicted_{code}")
        for code in range(5)
    ]
    return (
        drop_incomplete(df, ["risk_category", "predicted_risk_category"])
        .groupBy("risk_category")
        .agg(*cells)
        .orderBy("risk_category")
    )


def available(df: DataFrame) -> set[str]:
    """The questions that the columns of a table allow, by the name of their function."""
    has = set(df.columns)
    category = bool(has & {"risk_category", "risk_category_text"})
    needs = {
        "category_distribution": category,
        "actual_vs_predicted": {"risk_category", "predicted_risk_category"} <= has,
        "risk_over_time": category and "date" in has,
        "mean_risk_by_state": {"state", "risk_category"} <= has,
        "top_high_risk_states": {"state", "risk_category"} <= has,
        "filter_options": {"state", "risk_category", "date"} <= has,
        "details": {"state", "county", "date"} <= has,
    }
    return {name for name, enough in needs.items() if enough}


def risk_over_time(df: DataFrame) -> DataFrame:
    """Predictions per day and category label; days without any are not filled in.

    A date that is text and no ISO date counts as missing, and its row is left out.
    """
    return _labelled(with_date(df), "date").orderBy("date", "risk_category_text")


def mean_risk_by_state(
    df: DataFrame, codes: DataFrame | None = None, with_codes: bool = True
) -> DataFrame:
    """Mean category per state.

    With codes, states without a code are left out and the result is sorted by state;
    without, the highest mean comes first. A code table is joined to the few state
    rows after the aggregate, never to the predictions. If there are no codes at all, the
    form without codes is given.
    """
    known = df.where(F.col("state").isNotNull())
    level = _mean(df, "risk_category").alias("risk_level")
    if not with_codes or (codes is None and "state_code" not in df.columns):
        return known.groupBy("state").agg(level).orderBy(F.desc_nulls_last("risk_level"), "state")
    if codes is not None:
        means = known.drop("state_code").groupBy("state").agg(level)
        coded = means.join(drop_incomplete(one_code_per_state(codes)), "state")
    else:
        coded = (
            known.where(F.col("state_code").isNotNull()).groupBy("state", "state_code").agg(level)
        )
    return coded.select("state", "state_code", "risk_level").orderBy("state", "state_code")


def unmatched_states(df: DataFrame, codes: DataFrame) -> DataFrame:
    """States without a code, which the means by state leave out, and their predictions."""
    counts = df.where(F.col("state").isNotNull()).groupBy("state").agg(_rows(df).alias("n"))
    coded = with_state_code(counts, codes)
    return coded.where(F.col("state_code").isNull()).select("state", "n").orderBy("state")


def high_risk(df: DataFrame) -> DataFrame:
    return df.where(F.col("risk_category") >= HIGH_RISK_CODE)


def high_risk_by_state(df: DataFrame, distinct: bool = False) -> DataFrame:
    """High-risk predictions, or distinct high-risk counties, per state that has any."""
    risky = high_risk(df).where(F.col("state").isNotNull()).groupBy("state")
    if distinct:
        return risky.agg(F.count_distinct("county").alias("high_risk_counties"))
    return risky.agg(_rows(df).alias("high_risk_rows"))


def state_overview(df: DataFrame) -> DataFrame:
    """Mean category and number of high-risk predictions (null for none) per state."""
    high = _rows(df, F.col("risk_category") >= HIGH_RISK_CODE)
    return (
        df.where(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            _mean(df, "risk_category").alias("risk_level"),
            F.nullif(high, F.lit(0)).alias("high_risk_rows"),
        )
    )


def top_high_risk_states(df: DataFrame, k: int = 10, distinct: bool = False) -> DataFrame:
    """The k states with most high-risk predictions, or with most high-risk counties."""
    counts = high_risk_by_state(df, distinct)
    return counts.orderBy(F.desc(counts.columns[-1]), "state").limit(k)


def _label_of(df: DataFrame, code: str) -> Column | None:
    if f"{code}_text" in df.columns:
        return F.col(f"{code}_text")
    return category_label(F.col(code)) if code in df.columns else None


def high_risk_table(df: DataFrame) -> DataFrame:
    """High-risk predictions sorted by state, county and date, nulls last.

    The number of the input partition ends the sort key, so that the range partitions can
    cut through a day of a county, or a set of equal rows, that holds a large share of the
    table. A partition that is computed again gives its rows the same number.
    """
    return (
        high_risk(df)
        .select(
            F.col("state").alias("State"),
            F.col("county").alias("County"),
            F.col("date").alias("Date"),
            _label_of(df, "risk_category").alias("Risk Category"),
            F.spark_partition_id().alias("part"),
        )
        .orderBy(
            *[F.asc_nulls_last(c) for c in ("State", "County", "Date")],
            "part",
        )
        .drop("part")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column, null left out."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def risk_options(df: DataFrame) -> DataFrame:
    """The labels that occur, null left out.

    In alphabetical order where the table carries label text, else in order of the codes. The
    distinct runs over codes where there are any, and labels the few that remain.
    """
    text = "risk_category_text"
    if "risk_category" not in df.columns:
        return distinct_values(df, text)
    codes = df.select("risk_category").distinct()
    labels = codes.withColumn(text, category_label(F.col("risk_category")))
    known = labels.where(F.col(text).isNotNull())
    return known.orderBy(text if text in df.columns else "risk_category").select(text)


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def filter_options(df: DataFrame) -> DataFrame:
    """One row: first and last date, number of states and of categories.

    The distinct counts run over the few state and category pairs that remain after the
    first aggregate, not over copies of the predictions.
    """
    pairs = df.groupBy("state", "risk_category").agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )
    return pairs.agg(
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.count_distinct("state").alias("states"),
        F.count_distinct("risk_category").alias("categories"),
    )


def filter_predictions(
    df: DataFrame,
    state: str | None = None,
    risk: str | int | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Conjunction of the filters that are given; "All" and None leave one out.

    The category may be a label or a code. A label is turned into its code when the plan is
    built, so that the scan filters an integer. The date range is inclusive and applies
    only if both ends are given and the table has dates.
    """
    kept = df
    if state not in (None, NO_FILTER):
        kept = kept.where(F.col("state") == state)
    if risk not in (None, NO_FILTER):
        kept = kept.where(_risk_is(df, risk))
    if start is not None and end is not None and "date" in df.columns:
        kept = with_date(kept)
        low, high = (F.lit(str(day)).cast("date") for day in (start, end))
        kept = kept.where(F.col("date").between(low, high))
    return kept


def filtered_count(df: DataFrame, **filters) -> DataFrame:
    """One row: how many predictions pass the filters; the summary suffices for this."""
    rows = F.coalesce(_rows(df), F.lit(0).cast("long"))
    return filter_predictions(df, **filters).agg(rows.alias("n"))


def _risk_is(df: DataFrame, risk: str | int) -> Column:
    if isinstance(risk, str) and "risk_category" not in df.columns:
        return F.col("risk_category_text") == risk
    code = code_of_label(risk) if isinstance(risk, str) else risk
    return F.lit(False) if code is None else F.col("risk_category") == code


def display_view(df: DataFrame) -> DataFrame:
    """State, County, Date and the labels, under the names a reader sees."""
    columns = [
        F.col("state").alias("State"),
        F.col("county").alias("County"),
        F.col("date").alias("Date"),
    ]
    actual = _label_of(df, "risk_category")
    if actual is not None:
        columns.append(actual.alias("Risk Category"))
    predicted = _label_of(df, "predicted_risk_category")
    missing = F.lit(None).cast("string")
    columns.append((missing if predicted is None else predicted).alias("Predicted Risk"))
    return df.select(*columns)
