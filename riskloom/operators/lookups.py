"""Left lookups against dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import US_STATE_CODES


def lookup_join(df: DataFrame, dim: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join to a dimension.

    No hint: Catalyst broadcasts a side whose size is below the session's threshold, and
    adaptive execution measures what it does not know. A larger dimension is joined by
    shuffle, with the partitions of hot keys split between tasks.
    """
    return df.join(dim, on, "left")


def us_state_codes(spark: SparkSession) -> DataFrame:
    """The fifty states and their codes."""
    return spark.createDataFrame(
        list(US_STATE_CODES.items()), "state STRING, state_code STRING"
    )


def conflicting_codes(codes: DataFrame) -> DataFrame:
    """States that a dimension gives several codes, and those codes; none if it is sound."""
    known = codes.where("state IS NOT NULL AND state_code IS NOT NULL")
    per_state = known.groupBy("state").agg(
        F.min("state_code").alias("used"), F.max("state_code").alias("other")
    )
    return per_state.where("used <> other").orderBy("state")


def one_code_per_state(codes: DataFrame) -> DataFrame:
    """A dimension whose key is unique, so a lookup cannot multiply rows.

    Of several codes the smallest is used; conflicting_codes lists such states.
    """
    return codes.where(F.col("state").isNotNull()).groupBy("state").agg(
        F.min("state_code").alias("state_code")
    )


def with_state_code(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Add state_code, null for a state without one; the fifty states by default."""
    bare = df.drop("state_code")
    if codes is None:
        return bare.join(F.broadcast(us_state_codes(df.sparkSession)), "state", "left")
    pairs = codes.select("state", "state_code")
    return lookup_join(bare, one_code_per_state(pairs), "state")
