"""Score, category and label columns."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.constants import FEATURE_COLUMNS, LABEL_COLUMN, RISK_SPLITS
from riskloom.functions.risk import category_label, risk_category, risk_score


def with_risk_score(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_score", risk_score(F.col("cases"), F.col("deaths")))


def with_risk_category(
    df: DataFrame, score: str = "risk_score", category: str = "risk_category"
) -> DataFrame:
    return df.withColumn(category, risk_category(F.col(score)))


def with_labels(df: DataFrame) -> DataFrame:
    """Add a text column for each category column that is present."""
    present = [c for c in ("risk_category", "predicted_risk_category") if c in df.columns]
    return df.withColumns({f"{c}_text": category_label(F.col(c)) for c in present})


def bucketizer() -> Bucketizer:
    """The category as an ML stage: a double whose metadata names all five classes."""
    return Bucketizer(splits=RISK_SPLITS, inputCol="risk_score", outputCol=LABEL_COLUMN)


def assembler() -> VectorAssembler:
    """Feature vector; rows with a missing feature are left out."""
    return VectorAssembler(
        inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="skip"
    )
