from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.llm import topk_search as tk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, is_query):
    ok = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((vec_id, [math.floor(64 * x) for x in v]))
    first = {}
    for vec_id, v in sorted(ok):
        if is_query(vec_id):
            first.setdefault(vec_id, v)
    out = []
    for q, v in first.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k=5, **limits):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = tk.search(table, F.col("vec_id") % 20 == 0, k, **limits)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("limits", [{}, {"shard_rows": 7, "batch_queries": 3}])
def test_equals_brute_force(spark, limits):
    rnd = random.Random(2)
    # Halves and quarters are exact in float; many ties.
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)]) for i in range(300)]
    assert run(spark, rows, **limits) == brute(rows, 5, lambda i: i % 20 == 0)


def test_odd_vectors(spark):
    rows = [
        (0, [0.5, -0.25]), (20, None), (40, [None, 1.0]), (60, [math.nan, 1.0]), (80, [math.inf, 0.0]),
        (100, []), (120, [0.5]), (140, [0.5, 0.5, 0.5]), (1, [0.5, -0.25]), (2, [0.5, -0.25]),
        (2, [0.5, -0.25]), (160, [0.25, 1.0]), (160, [0.5, 1.0]), (None, [1.0, 1.0]), (3, [0.0, 0.0]),
    ]
    assert run(spark, rows, 4) == brute(rows, 4, lambda i: i % 20 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**20 - i), 1.0]) for i in range(25)]
    assert run(spark, rows, 6) == brute(rows, 6, lambda i: i % 20 == 0)
    huge = [(i, [2.0**60, 1.0]) for i in range(4)]
    assert [r[1:] for r in run(spark, huge, 2)] == [(1, 1, 2**63 - 1), (2, 2, 2**63 - 1)]


def test_none_or_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(20, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (2, [1.0])]) == [(0, 1, 2, 4096)]


def test_blocks_are_left_out():
    """With a floor above a block's bound the block is not scored."""
    import numpy as np
    import pyarrow as pa

    near, far = np.full((4, 2), 50, np.int64), np.full((4, 2), 1, np.int64)
    index = pa.table({
        "ids": pa.array([np.arange(4).tobytes(), np.arange(4, 8).tobytes()], pa.binary()),
        "width": [2, 2],
        "forward": pa.array([near.tobytes(), far.tobytes()], pa.binary()),
        "highest": pa.array([near[0].tobytes(), far[0].tobytes()], pa.binary()),
        "lowest": pa.array([near[0].tobytes(), far[0].tobytes()], pa.binary()),
    })
    queries = pa.table({"query_id": [99], "vector": [[10, 10]], "floor": pa.array([100], pa.int64())})
    ids = tk._search(index, queries, 2)[1]
    assert ids == [0, 1]


def test_a_query_is_not_sent_to_shards_below_its_floor():
    import numpy as np
    import pyarrow as pa

    def ends(*values):
        return pa.array([np.array(v, np.int64).tobytes() for v in values], pa.binary())

    # Shard 7 has two blocks, one of which reaches the floor; shard 9 has none; 5 is the home.
    index = pa.table({
        "shard": pa.array([9, 7, 5, 7], pa.int64()),
        "width": [2, 2, 2, 1],
        "highest": ends([4, 4], [1, 1], [90, 90], [50]),
        "lowest": ends([-9, -9], [0, 0], [0, 0], [0]),
    })
    queries = pa.table({
        "query_id": [1, 2, 3],
        "vector": [[10, 10], [10, 10], [-10, 0]],
        "floor": pa.array([100, None, 90], pa.int64()),
        "home": pa.array([5, 5, 5], pa.int64()),
    })
    out = tk._visits(index, queries)
    assert list(zip(*(out[n].to_pylist() for n in ("query_id", "shard")))) == [
        (1, 7), (2, 7), (2, 9), (3, 9)
    ]


def test_clustered_vectors_visit_few_shards(spark, monkeypatch):
    """Clusters far from each other: a query is sent to its own cluster's shards only."""
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        v = [rnd.random() / 8 for _ in range(8)]
        v[i % 8] += 4.0
        rows.append((i, v))
    sent = []
    visited = tk._visited

    def counted(*args):
        out = visited(*args)
        sent.append(out.count())
        return out

    monkeypatch.setattr(tk, "_visited", counted)
    found = run(spark, rows, 5, shard_rows=20, batch_queries=4)
    assert found == brute(rows, 5, lambda i: i % 20 == 0)
    assert 0 < sent[0] < 30 * 32 / 3
