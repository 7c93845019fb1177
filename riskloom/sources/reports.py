"""Report files: raw CSV, curated Parquet, several feeds as one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas


UNREADABLE = "_unreadable"


def read_reports_csv(
    spark: SparkSession,
    path: str | list[str],
    check_header: bool = True,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Raw reports with their declared schema; a count that is no integer becomes null.

    Columns bind by position. With check_header a file whose header names other columns, or
    the same ones in another order, fails instead of swapping values. With keep_unreadable a
    line that does not fit the schema is also kept as text, so that such lines can be counted.
    """
    schema = schemas.RAW_REPORT
    if keep_unreadable:
        schema = f"{schema}, {UNREADABLE} STRING"
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        enforceSchema=not check_header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=UNREADABLE,
    )


def read_reports(spark: SparkSession, root: str, year: int | None = None) -> DataFrame:
    """Curated reports as message columns; a year reads only the folders of that year."""
    reports = spark.read.parquet(root)
    if year is not None:
        reports = reports.where(F.col("annee") == year)
    parts = {name: F.col(name).cast("int") for name in ("mois", "jour")}
    return reports.withColumns(parts).select(schemas.MESSAGE_COLUMNS)


def union_feeds(feeds: dict[str, DataFrame]) -> DataFrame:
    """All rows of all feeds with the feed's name; a column a feed lacks is null there."""
    named = [df.withColumn("source", F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), named)


def resolve_feeds(feeds: dict[str, DataFrame], keys: Sequence[str], time: str) -> DataFrame:
    """One report per key out of several feeds, named in the order of trust.

    The first feed that has the key gives the report; of its reports the newest by time, then
    the largest by the other columns in their order, where null is smallest. All of it is one
    maximum over a struct, which shrinks to a row per key and task before the shuffle, however
    many reports a key has.

    source names the feed the report is from, sources all feeds that have the key, in the order
    of trust, reports is their number of reports, and differing lists the columns on which
    reports of the key disagree (null says nothing). A report without a whole key cannot be
    matched with others and stays as it is. Feeds may lack columns of others, which are null.
    """
    names = list(feeds)
    rows = union_feeds(feeds)
    clashing = {"sources", "reports", "differing"} & set(rows.columns)
    if clashing:
        raise ValueError(f"columns of a feed have names of the result: {sorted(clashing)}")
    own = [c for c in rows.columns if c not in (*keys, time, "source")]
    rank = reduce(
        lambda chain, i: chain.when(F.col("source") == names[i], F.lit(-i)),
        range(1, len(names)),
        F.when(F.col("source") == names[0], F.lit(0)),
    )
    values = [F.col(c) for c in (time, *own) if c not in keys]
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    best = (
        rows.where(~keyless)
        .withColumn("rank", rank)
        .groupBy(*keys)
        .agg(
            F.max(F.struct("rank", *values)).alias("best"),
            *[F.max(F.col("rank") == -i).alias(f"feed_{i}") for i in range(len(names))],
            F.count(F.lit(1)).alias("reports"),
            *[(F.min(c) != F.max(c)).alias(f"differs_{c}") for c in own],
        )
    )
    named = F.array(*[F.lit(n) for n in names])
    found = [F.when(F.col(f"feed_{i}"), F.lit(n)) for i, n in enumerate(names)]
    differs = [F.when(F.col(f"differs_{c}"), F.lit(c)) for c in own]
    columns = [c for c in rows.columns if c != "source"]
    matched = best.select(
        *[F.col(c) if c in keys else F.col(f"best.{c}").alias(c) for c in columns],
        F.get(named, -F.col("best.rank")).alias("source"),
        F.array_compact(F.array(*found)).alias("sources"),
        "reports",
        F.array_compact(F.array(*differs)).cast("array<string>").alias("differing"),
    )
    single = rows.where(keyless).select(
        *columns,
        "source",
        F.array("source").alias("sources"),
        F.lit(1).cast("long").alias("reports"),
        F.array().cast("array<string>").alias("differing"),
    )
    return matched.unionByName(single)
