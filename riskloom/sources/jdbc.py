"""Predictions kept in a relational table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.constants import PREDICTIONS_TABLE
from riskloom.functions.dates import with_date

SETTING = "spark.riskloom.jdbc."

# Columns that append_batch_jdbc adds: the stream and its micro-batch, the delivery of it that
# wrote the row, the row's number in that delivery, and an even spread for parallel reads.
STREAM_COLUMN = "stream_id"
BATCH_COLUMN = "batch_id"
DELIVERY_COLUMN = "delivery"
ROW_COLUMN = "row_id"
SPREAD_COLUMN = "spread"
SPREAD_VALUES = 1 << 20


@dataclass(frozen=True)
class JdbcTable:
    """Where the table is; options carry driver, user, password, fetchsize and the like."""

    url: str
    table: str = PREDICTIONS_TABLE
    options: dict[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_settings(cls, spark: SparkSession, table: str | None = None) -> JdbcTable | None:
        """The table named by the session's spark.riskloom.jdbc.* settings, None if unset."""
        url = spark.conf.get(SETTING + "url", None)
        if not url:
            return None
        names = ["driver", "user", "password"]
        options = {name: spark.conf.get(SETTING + name, None) for name in names}
        return cls(
            url,
            table or spark.conf.get(SETTING + "table", PREDICTIONS_TABLE),
            {name: value for name, value in options.items() if value is not None},
        )

    def scan(self, spark: SparkSession, **options: str) -> DataFrame:
        """The table as one partition unless the options split it."""
        reader = spark.read.format("jdbc").option("url", self.url).option("dbtable", self.table)
        return reader.options(**self.options).options(**options).load()

    def ask(self, spark: SparkSession, aggregates: list[str], condition: str = "") -> Row:
        """One row of aggregates, computed by the database itself."""
        select = f"SELECT {', '.join(f'{a} AS a{i}' for i, a in enumerate(aggregates))}"
        text = f"{select} FROM {self.table}" + (f" WHERE {condition}" if condition else "")
        reader = spark.read.format("jdbc").option("url", self.url).option("query", text)
        return reader.options(**self.options).load().first()

    def beside(self, purpose: str) -> JdbcTable:
        """A table of this library next to this one."""
        return replace(self, table=f"{self.table}_{purpose}")

    def name(self, column: str) -> str:
        """A column name as the database expects it in SQL text."""
        mark = "`" if self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:")) else '"'
        return f"{mark}{column}{mark}"


def read_predictions(
    spark: SparkSession,
    source: JdbcTable,
    partitions: int = 16,
    predicates: list[str] | None = None,
) -> DataFrame:
    """The five prediction columns, read by several tasks at once, repeated writes left out.

    Tables written by this library are split by their spread column, which is even whatever
    the data; others by date range, from first to last date. Conditions of the caller's own
    choice (predicates) take precedence, for a table whose dates are uneven.
    """
    whole = source.scan(spark)
    if predicates:
        split = spark.read.jdbc(
            source.url, source.table, predicates=predicates, properties=source.options
        )
    elif SPREAD_COLUMN in whole.columns:
        split = source.scan(
            spark,
            partitionColumn=SPREAD_COLUMN,
            lowerBound="0",
            upperBound=str(SPREAD_VALUES),
            numPartitions=str(partitions),
        )
    else:
        date = source.name("date")
        first, last = source.ask(spark, [f"MIN({date})", f"MAX({date})"])
        split = whole
        if first is not None and first < last:
            split = source.scan(
                spark,
                partitionColumn="date",
                lowerBound=str(first),
                upperBound=str(last),
                numPartitions=str(partitions),
            )
    rows = without_repeats(split, schemas.PREDICTION_COLUMNS)
    return with_date(rows)


def without_repeats(stored: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, each row of a delivery once.

    A task whose executor is lost after its commit runs again and writes its rows a second
    time, under the same numbers. Grouping by all columns lets filters pass to the database.
    """
    if ROW_COLUMN not in stored.columns:
        return stored.select(columns)
    return stored.select(*columns, DELIVERY_COLUMN, ROW_COLUMN).distinct().select(columns)
