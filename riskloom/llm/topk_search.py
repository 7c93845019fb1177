"""Exact top-k by inner product, a block of rows at a time.

Vectors are dealt to shards by the pivot they are closest to, and each shard is cut into
blocks of neighbouring rows: a forward index (ids and components) and, per term, that is
component, its largest and smallest value. For a query a block cannot score more than the
sum over its terms of the larger of the two products. Queries visit the blocks of a shard
in the order of these sums and stop when the next sum falls below their k-th score.

Queries first search the shard they lie in; its k-th score is the floor for all others. The
stored extremes of the blocks, many shards at a time, tell which shards have a block that can
reach the floor; only to these the query is sent, and only for these a shard's forward index
is. Queries are dealt to batches of a bounded size; a task has one shard and one batch.
Nothing is approximate: pivots decide the order only.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part,
nor do rows without an id. A shorter vector counts as filled up with zeros; an empty one
scores 0 with all. Rows with the query's id are left out; other repeated rows are separate
candidates, and repeated queries are asked once, with the first of their vectors. Ties go to
the smaller id. Fewer candidates than k are all returned. Sums beyond 2**53 are computed
with unbounded integers; a score that does not fit a long counts as the closest one that does.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

SCALE = 64
PIVOTS = 16
PIVOT_SAMPLE = 512  # rows with the smallest hashes, from which pivots are taken
SHARD_ROWS = 8192
BLOCK_ROWS = 128
BATCH_QUERIES = 1024
REGION_SHARDS = 64  # whose block extremes one task holds
SLICE_QUERIES = 128
EXACT = 2.0**53


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of each component; only vectors that take part."""

    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return table.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(usable(x), F.lit(False)))
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias(
            "vector"
        ),
    )


def _matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Rows of longs, filled up with zeros; floats where every product sum is exact."""
    rows = column.to_pylist()
    width = max([width or 0, *map(len, rows)])
    out = np.zeros((len(rows), width), np.int64)
    for row, values in zip(out, rows):
        row[: len(values)] = values
    return out


def _same_width(*parts: np.ndarray) -> list[np.ndarray]:
    width = max(p.shape[1] for p in parts)
    return [np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]


def _numbers(*parts: np.ndarray) -> list[np.ndarray]:
    """As floats if all sums of products stay exact, else as unbounded integers."""
    parts = _same_width(*parts)
    largest = [float(np.abs(p.astype(float)).max(initial=0)) for p in parts]
    if max(largest) ** 2 * parts[0].shape[1] < EXACT:
        return [p.astype(float) for p in parts]
    return [p.astype(object) for p in parts]


def pivots(vectors: DataFrame, count: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Some vectors of a bounded sample that are far from each other, scaled to length 1."""
    rows = (
        vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()
    )
    if not rows:
        return np.zeros((1, 1))
    x = _matrix(pa.chunked_array([pa.array([r[0] for r in rows], pa.list_(pa.int64()))]))
    x = x.astype(float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


def sharded(vectors: DataFrame, centres: np.ndarray, shard_rows: int) -> DataFrame:
    """vec_id, vector, shard: the closest pivot, large ones split by the id's hash."""
    @F.pandas_udf("int")
    def closest(values: pd.Series) -> pd.Series:
        x = _matrix(pa.chunked_array([pa.array(values, pa.list_(pa.int64()))]), centres.shape[1])
        x, c = _same_width(x.astype(float), centres)
        return pd.Series((x @ c.T).argmax(axis=1).astype("int32"))

    placed = vectors.withColumn("pivot", closest("vector"))
    placed = materialize(placed, "topk-vectors")
    counts = placed.groupBy("pivot").count().collect()  # a row per pivot
    parts = {r["pivot"]: max(1, -(-r["count"] // shard_rows)) for r in counts}
    split = F.create_map(*[F.lit(v) for kv in parts.items() for v in kv]) if parts else None
    part = F.pmod(F.xxhash64("vec_id"), split[F.col("pivot")]) if parts else F.lit(0)
    return placed.select("vec_id", "vector", (part * len(centres) + F.col("pivot")).alias("shard"))


def blocks(placed: DataFrame, centres: np.ndarray, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index: shard, ids, width, forward (row by row), highest, lowest; a row per block."""

    def cut(rows: pa.Table) -> pa.Table:
        x = _matrix(rows["vector"])
        ids = rows["vec_id"].to_numpy()
        shard = rows["shard"][0].as_py()
        a, c = _same_width(x.astype(float), centres)
        order = np.lexsort((ids, -(a @ c[shard % len(centres)])))
        out = {n: [] for n in ("shard", "ids", "width", "forward", "highest", "lowest")}
        for start in range(0, len(ids), block_rows):
            own = order[start : start + block_rows]
            part = np.ascontiguousarray(x[own])
            out["shard"].append(shard)
            out["ids"].append(ids[own].tobytes())
            out["width"].append(x.shape[1])
            out["forward"].append(part.tobytes())
            out["highest"].append(part.max(axis=0).tobytes())
            out["lowest"].append(part.min(axis=0).tobytes())
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})

    schema = "shard long, ids binary, width long, forward binary, highest binary, lowest binary"
    return placed.groupBy("shard").applyInArrow(cut, schema)


def _extremes(index: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The stored largest and smallest components, a row per block."""
    width = max(index["width"].to_pylist())
    out = [np.zeros((index.num_rows, width), np.int64) for _ in range(2)]
    for matrix, name in zip(out, ("highest", "lowest")):
        for row, blob in zip(matrix, index[name].to_pylist()):
            values = np.frombuffer(blob, np.int64)
            row[: len(values)] = values
    return out[0], out[1]


def _as_long(scores: np.ndarray) -> np.ndarray:
    """Scores that do not fit a long become the closest one that does."""
    if scores.dtype != object:
        return scores
    return np.minimum(np.maximum(scores, -(2**63)), 2**63 - 1)


def _bounds(asked: np.ndarray, highest: np.ndarray, lowest: np.ndarray) -> np.ndarray:
    """What no row of a block exceeds, for each query and block."""
    zero = asked * 0
    return _as_long(np.maximum(asked, zero) @ highest.T + np.minimum(asked, zero) @ lowest.T)


def _visits(index: pa.Table, queries: pa.Table) -> pa.Table:
    """The queries with each shard, but their home, that has a block which reaches their floor."""
    asked, highest, lowest = _numbers(_matrix(queries["vector"]), *_extremes(index))
    shards, at = np.unique(index["shard"].to_numpy(), return_inverse=True)
    order = np.argsort(at, kind="stable")
    starts = np.searchsorted(at[order], np.arange(len(shards)))
    home, floors = queries["home"].to_numpy(), queries["floor"].to_pylist()
    rows, to = [], []
    for first in range(0, len(asked), SLICE_QUERIES):
        part = slice(first, first + SLICE_QUERIES)
        bounds = _bounds(asked[part], highest[order], lowest[order])
        best = np.maximum.reduceat(bounds, starts, axis=1)
        for q, (own, floor) in enumerate(zip(home[part], floors[part])):
            open_ = shards != own
            if floor is not None:
                open_ &= (best[q] >= floor).astype(bool)
            to.append(shards[open_])
            rows.append(np.full(int(open_.sum()), first + q))
    out = queries.select(["query_id", "vector", "floor"]).take(pa.array(np.concatenate(rows)))
    return out.append_column("shard", pa.array(np.concatenate(to), pa.int64()))


def _visited(index: DataFrame, queries: DataFrame, n_shards: int, batch_queries: int) -> DataFrame:
    """query_id, vector, floor, shard: where each query has to look beyond its home.

    A task holds the block extremes of a region, about REGION_SHARDS shards, and a batch of
    queries; vectors are shipped once to each region, extremes once to each batch.
    """
    regions = -(-n_shards // REGION_SHARDS)
    batches = max(1, -(-queries.count() // batch_queries))
    extremes = index.select(
        F.pmod(F.xxhash64("shard"), F.lit(regions)).alias("region"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long"))).alias("batch"),
        *("shard", "width", "highest", "lowest"),
    )
    asked = queries.select(
        "query_id",
        "vector",
        "floor",
        F.col("shard").alias("home"),
        F.pmod(F.xxhash64("query_id"), F.lit(batches)).alias("batch"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(regions - 1).cast("long"))).alias("region"),
    )
    names = ["query_id", "vector", "floor", "shard"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not (index.num_rows and queries.num_rows):
            return pa.table({n: pa.array([], k) for n, k in zip(names, kinds)})
        return _visits(index, queries)

    return (
        asked.groupBy("region", "batch")
        .cogroup(extremes.groupBy("region", "batch"))
        .applyInArrow(run, "query_id long, vector array<long>, floor long, shard long")
    )


def _search(index: pa.Table, queries: pa.Table, k: int) -> tuple[list, list, list]:
    """query ids, ids and scores of what may be among each query's k best."""
    width = index["width"][0].as_py()
    forward = [
        np.frombuffer(b, np.int64).reshape(-1, width) if width else np.zeros((len(i) // 8, 0))
        for b, i in zip(index["forward"].to_pylist(), index["ids"].to_pylist())
    ]
    ids = [np.frombuffer(b, np.int64) for b in index["ids"].to_pylist()]
    asked, highest, lowest, *rows = _numbers(_matrix(queries["vector"]), *_extremes(index), *forward)
    bounds = _bounds(asked, highest, lowest)
    found = ([], [], [])
    for q, query_id, floor in zip(
        range(len(asked)), queries["query_id"].to_pylist(), queries["floor"].to_pylist()
    ):
        least, best, who = floor, np.empty(0, asked.dtype), np.empty(0, np.int64)
        for b in np.argsort(-bounds[q], kind="stable"):
            if least is not None and bounds[q, b] < least:
                break
            scores = _as_long(rows[b] @ asked[q])
            keep = ids[b] != query_id
            if least is not None:
                keep &= (scores >= least).astype(bool)
            if not keep.any():
                continue
            best = np.concatenate([best, scores[keep]])
            who = np.concatenate([who, ids[b][keep]])
            if len(best) > k:
                order = np.lexsort((who, -best))[:k]
                best, who = best[order], who[order]
            if len(best) == k:
                low = int(best.min())
                least = low if least is None else max(least, low)
        found[0].extend([query_id] * len(best))
        found[1].extend(who.tolist())
        found[2].extend(int(s) for s in best)
    return found


def _searched(index: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        found = ([], [], []) if not (index.num_rows and queries.num_rows) else None
        found = found or _search(index, queries, k)
        names = ["query_id", "vec_id", "score"]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(names, found)})

    return (
        queries.groupBy(*keys)
        .cogroup(index.groupBy(*keys))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    table: DataFrame,
    is_query: Column,
    k: int,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    batch_queries: int = BATCH_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row that is a query."""
    vectors = materialize(quantised(table, scale), "topk-quantised")
    centres = pivots(vectors)
    placed = materialize(sharded(vectors, centres, shard_rows), "topk-placed")
    index = materialize(blocks(placed, centres), "topk-blocks")
    asked = placed.where(is_query).groupBy("vec_id").agg(
        F.min(F.struct("vector", "shard")).alias("x")
    )
    asked = asked.select(F.col("vec_id").alias("query_id"), "x.*")
    home = asked.withColumn("floor", F.lit(None).cast("long"))
    first = materialize(_searched(index, home, ["shard"], k), "topk-home")
    # Only a full list of k gives a floor: at least so many rows score as much.
    floors = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    floor = F.when(F.col("n") >= k, F.col("least"))
    queries = asked.join(floors, "query_id", "left").withColumn("floor", floor)
    queries = materialize(queries.select("query_id", "vector", "shard", "floor"), "topk-queries")
    n_shards = index.select("shard").distinct().count()
    if n_shards < 2:
        return _best(first, k).select("query_id", "rank", "vec_id", "score")
    visits = materialize(_visited(index, queries, n_shards, batch_queries), "topk-visits")
    # Each shard is shipped as often as its visitors fill batches, and not at all without any.
    loads = visits.groupBy("shard").agg(F.ceil(F.count("*") / batch_queries).alias("batches"))
    loads = materialize(loads, "topk-loads")
    batch = F.pmod(F.xxhash64("query_id"), F.col("batches")).alias("batch")
    visitors = visits.join(loads, "shard").select("query_id", "vector", "floor", "shard", batch)
    repeated = index.join(loads, "shard").withColumn(
        "batch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1))
    )
    rest = _searched(repeated.drop("batches"), visitors, ["shard", "batch"], k)
    return _best(first.union(rest), k).select("query_id", "rank", "vec_id", "score")
