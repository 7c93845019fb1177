"""County reports and predictions derived from order tables.

There is no report data of the right shape at hand, so line items stand in: the supplier's
nation is the state, the supplier the county, the ship date the report date, the price the
case count and the quantity the death count. Each dimension is joined as a plain scan, so
that Catalyst sees its true size: it is broadcast only below the session's threshold, and
joined by shuffle with hot keys split by adaptive execution above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.risk import risk_category
from riskloom.operators.cleaning import drop_incomplete
from riskloom.operators.scoring import with_risk_category, with_risk_score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state, county, date, cases, deaths and the mostly empty column note."""
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    located = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    correction = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    sign = F.when(correction, F.lit(-1)).otherwise(F.lit(1))
    return located.select(
        F.col("n_name").alias("state"),
        F.col("s_name").alias("county"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.floor("l_extendedprice").cast("int") * sign).alias("cases"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int")).alias("deaths"),
        F.when(F.col("l_linenumber") == 1, F.col("l_linestatus")).alias("note"),
    )


def complete_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).drop("note").transform(drop_incomplete)


def scored_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_reports(spark, sf_dir).transform(with_risk_score)


def case_scorer(df: DataFrame) -> DataFrame:
    """Deterministic stand-in for a model: the category of the case count alone."""
    return df.withColumn("predicted_risk_category", risk_category(F.col("cases").cast("long")))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        scored_reports(spark, sf_dir)
        .transform(with_risk_category)
        .transform(case_scorer)
        .select(
            "state", "county", "date", "risk_score", "risk_category", "predicted_risk_category"
        )
    )


def order_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second feed, without death counts: orders by the customer's nation."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    located = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return located.select(
        F.col("n_name").alias("state"),
        F.col("c_name").alias("county"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.floor("o_totalprice").cast("int").alias("cases"),
    )


def state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes for the first twenty nations only, so that some states have none."""
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_nationkey") < 20)
        .select(
            F.col("n_name").alias("state"),
            F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(
                "state_code"
            ),
        )
    )
