"""Regularised quadratic discriminant over statistics of documents.

Every document is described by a few transformed counts of its text; no label, language,
source or id is among them. Per class the mean and the covariance are sums that Spark
aggregates over all labelled training documents, a small matrix whatever their number. The
covariance is shrunk towards the pooled one and its diagonal, and factored once (Cholesky);
a score is the difference of the two classes' log densities, from Mahalanobis distances by
solving against the cached factors.

Defined cases: a null or empty text has the statistics of no words and gets a score like any
other. Rows are documents. Contradictory labels of a doc_id all count; labels other than 0
and 1 and null labels do not. If a class has no training document, every score is the prior
of the other class; without training documents it is 0.5.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import WHITE, WORDS, add_by_text, fresh
from riskloom.llm.quality_rules import (
    CONTINUATION,
    DIGITS,
    LETTERS,
    SYMBOLS,
    UPPER,
    repeated_words,
)
from riskloom.session import materialize

STATISTICS = (
    "log_words",
    "word_length",
    "symbols",
    "upper",
    "marks",
    "digits",
    "letters",
    "variety",
    "repeats",
    "adjacent",
    "dup_lines",
    "line_words",
    "ends",
    "singles",
    "compression",
)
SHRINK_TO_POOLED = 0.3
SHRINK_TO_DIAGONAL = 0.1
FLOOR = 1e-3
FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.7


def _root(part: float, whole: float) -> float:
    return math.sqrt(part / whole) if whole else 0.0


def statistics(text: bytes | None) -> list[float]:
    """Shares as square roots and sizes as logarithms, so that they spread evenly."""
    text = text or b""
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    hashes = WORDS.of(words)
    chars = len(text.translate(None, WHITE + CONTINUATION))

    def count(these: bytes) -> int:
        return len(text) - len(text.translate(None, these))

    letters = count(LETTERS)
    other = len(text.translate(None, bytes(range(0x80)) + CONTINUATION))
    punctuation = b".,;:!?|"
    return [
        math.log1p(n),
        math.log1p(chars / n if n else 0),
        _root(count(SYMBOLS), n),
        _root(count(UPPER), letters),
        _root(count(b"!"), n),
        _root(count(DIGITS), chars),
        _root(letters + other, chars),
        _root(len(np.unique(hashes)), n),
        _root(repeated_words(hashes), n),
        _root(int((hashes[1:] == hashes[:-1]).sum()), n),
        _root(len(lines) - len(set(lines)), len(lines)),
        math.log1p(n / len(lines) if lines else 0),
        _root(count(b".?!"), n),
        _root(sum(len(w) == 1 for w in words), n),
        _root(count(punctuation), chars),
    ]


def with_statistics(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with an array of the statistics, and the (unused) name of that column."""
    (name,) = fresh(docs, "statistics")

    def make(texts: Iterable[bytes | None]) -> dict[str, list]:
        return {name: [statistics(t) for t in texts]}

    field = T.StructField(name, T.ArrayType(T.DoubleType()))
    return add_by_text(docs, "text", [field], make), name


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, held: int = HELD_OUT) -> Column:
    """Whether crc32 of the id as text leaves that remainder; a null id is never held out."""
    text = F.col(doc_id).cast("long").cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % folds == held, F.lit(False))


def _sums(labelled: DataFrame, stats: str, label: str) -> list:
    """Per class the count, the sums and the products of all pairs of statistics."""
    n = len(STATISTICS)
    values = [F.col(stats)[i] for i in range(n)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    products = [
        F.sum(values[i] * values[j]).alias(f"p{i}_{j}") for i in range(n) for j in range(i + 1)
    ]
    found = labelled.where(F.col(label).isin(0, 1)).groupBy(label)
    return found.agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()  # two rows


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1) the log prior, mean, Cholesky factor and log determinant."""

    priors: tuple[float, float]
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    determinants: tuple[float, ...] = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1, a value per row of x."""
        if not self.factors:
            return np.full(len(x), self.priors[1])
        logs = []
        for k in (0, 1):
            away = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
            distance = (away**2).sum(axis=0)
            logs.append(math.log(self.priors[k]) - 0.5 * (distance + self.determinants[k]))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame, stats: str, label: str) -> Discriminant:
    """From every labelled row; only sums over the rows leave Spark."""
    n = len(STATISTICS)
    counts, means, covariances = [0, 0], [None, None], [None, None]
    for row in _sums(labelled, stats, label):
        k, count = int(row[label]), row["n"]
        mean = np.array([row[f"s{i}"] for i in range(n)]) / count
        products = np.zeros((n, n))
        for i in range(n):
            for j in range(i + 1):
                products[i, j] = products[j, i] = row[f"p{i}_{j}"] / count
        counts[k], means[k] = count, mean
        covariances[k] = products - np.outer(mean, mean)
    total = sum(counts)
    if not all(counts):
        share = counts[1] / total if total else 0.5
        return Discriminant((1 - share, share))
    priors = (counts[0] / total, counts[1] / total)
    pooled = priors[0] * covariances[0] + priors[1] * covariances[1]
    factors, determinants = [], []
    for own in covariances:
        mixed = (1 - SHRINK_TO_POOLED) * own + SHRINK_TO_POOLED * pooled
        spread = np.diag(np.diag(mixed))
        shrunk = (1 - SHRINK_TO_DIAGONAL) * mixed + SHRINK_TO_DIAGONAL * spread
        factor = np.linalg.cholesky(shrunk + FLOOR * np.eye(n))
        factors.append(factor)
        determinants.append(2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(priors, tuple(means), tuple(factors), tuple(determinants))


def scored(docs: DataFrame, stats: str, model: Discriminant) -> tuple[DataFrame, str]:
    """docs with the score, and the (unused) name of that column."""
    (name,) = fresh(docs, "score")

    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy()) if len(values) else np.empty((0, len(STATISTICS)))
        return pd.Series(model.scores(x))

    return docs.withColumn(name, score(F.col(stats))), name


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD
) -> tuple[DataFrame, Discriminant]:
    """Every document scored by a model of the labelled ones that are not held out.

    Returns doc_id, the statistics, held_out, score and predicted; and the model.
    """
    own = docs.select("doc_id", "text")
    described, stats = with_statistics(own)
    described = materialize(described.drop("text"), "quality-statistics")
    known = labels.select(
        F.col("doc_id").alias("labelled_id"), F.col(label).cast("int").alias("label")
    ).where("label IS NOT NULL")
    training = described.where(~held_out()).join(
        known, F.col("doc_id") == F.col("labelled_id")
    )
    model = fit(training, stats, "label")
    out, score = scored(described, stats, model)
    predicted = (F.col(score) >= threshold).cast("int")
    return out.withColumns({"held_out": held_out(), "predicted": predicted}), model
