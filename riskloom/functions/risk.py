"""Risk score, category and label as built-in expressions that stay in codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.constants import DEATH_WEIGHT, RISK_LABELS, RISK_SPLITS


def risk_score(cases: Column, deaths: Column) -> Column:
    """Weighted count as a long, so that large counts cannot overflow; null if either is null."""
    return cases.cast("long") + deaths.cast("long") * F.lit(DEATH_WEIGHT).cast("long")


def risk_category(score: Column) -> Column:
    """Bucket 0 to 4 of an integer score; a null score stays null."""
    edges = [int(edge) for edge in RISK_SPLITS[1:-1]]
    below = reduce(
        lambda chain, item: chain.when(score < item[1], item[0]),
        list(enumerate(edges))[1:],
        F.when(score < edges[0], 0),
    )
    return below.when(score >= edges[-1], len(edges)).cast("int")


def category_label(code: Column) -> Column:
    """Label of a category code; null for an unknown code.

    An index into a constant array evaluates the code once. A chain of comparisons would
    repeat its expression per label wherever Catalyst pushes a test of the label down.
    """
    labels = F.array(*[F.lit(RISK_LABELS[code]) for code in sorted(RISK_LABELS)])
    return F.get(labels, code.cast("int"))


def code_of_label(label: str) -> int | None:
    """Code of a label, None if there is no such label."""
    return next((code for code, text in RISK_LABELS.items() if text == label), None)
