"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Neighbours of each node tied to the smallest among them and the node itself.

    edges are pairs a > b. The large star ties the larger neighbours of every node, the small
    star the smaller ones, and the node too. Minima are combined before the shuffle; a node's
    neighbours are never collected.
    """
    sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        sides = sides.union(edges.select("b", "a"))
    lowest = sides.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("low"))
    tied = sides.join(lowest, "node")
    if large:
        pairs = tied.where("other > node").select("other", "low")
    else:
        pairs = tied.select("other", "low").union(lowest.select("node", "low"))
    return pairs.toDF("a", "b").where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component: for every node of the edges (a, b) the smallest node reachable.

    Large and small stars alternate until the edges no longer change; then each node hangs on
    the smallest one of its component. The number of rounds grows with the logarithm of the
    longest path. A round is written to the shared folder, so a lost executor repeats one round
    at most. Loops and repeated edges are ignored; of no edges nothing is returned.
    """
    state = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = state.where("a > b").distinct()
    before = None
    while True:
        seen = Observation()
        marks = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 2**40).alias("sum")]
        state = materialize(state.observe(seen, *marks), "edges")
        found = (seen.get["n"], seen.get["sum"])
        if found == before or not found[0]:
            break
        before = found
        state = _stars(_stars(state, large=True), large=False)
    ends = state.select("a", "b").union(state.select("b", "b")).toDF("id", "component")
    return ends.distinct()
