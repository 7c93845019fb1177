from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if times[t[p : p + length]] > 1:
                gone[p + 1 : p + 1 + length] = True
        left = bytes(b for b, g in zip(t, gone[1:]) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), len(t) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, length, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cut, names = sd.without_repeats(docs, length, **options)
    out = cut.select("doc_id", *(names[c] for c in ("n_bytes", "n_removed", "n_spans", "kept")))
    return sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in out.collect()), key=str)


def texts(n, seed, letters="abc "):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choices(letters, k=rnd.randint(20, 120))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [
            rnd.choice(passages) if rnd.random() < 0.4 else "".join(rnd.choices(letters, k=rnd.randint(1, 90)))
            for _ in range(rnd.randint(1, 5))
        ]
        rows.append((i, "".join(parts)))
        if rnd.random() < 0.2:
            rows.append((i + 1000, rows[-1][1][rnd.randint(0, 5) :]))
    return rows


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh", "zyx"])
def test_suffix_array_is_the_sorted_suffixes(letters):
    rnd = random.Random(len(letters))
    for n in [1, 2, 3, *range(5, 400, 23)]:
        data = "".join(rnd.choices(letters, k=n)).encode()
        data = data[: n // 5 + 1] * 5 if n % 2 else data
        got = sd.suffix_array(np.frombuffer(data, np.uint8), len(data))
        assert got.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_only_smaller_suffixes_are_sorted_directly():
    data = np.frombuffer(b"mississippi", np.uint8)
    smaller = sd.smaller_than_next(data)
    assert np.flatnonzero(smaller).tolist() == [1, 4, 7]
    assert sd.sorted_directly(data, smaller, 11).tolist() == [7, 4, 1]


def test_shared_prefixes():
    data = np.frombuffer(b"abcdefghijklmnop-abcdefghijklmnop+abcdefghXX", np.uint8)
    for length in (8, 11, 16):
        got = sd.shared_prefixes(data, np.array([0, 17, 28]), length)
        assert got.tolist() == [True, False]
    assert sd.shared_prefixes(data, np.array([17, 0, 18]), 17).tolist() == [False, False]


def test_least_of_windows():
    values = np.random.default_rng(1).integers(0, 50, 333).astype(np.uint64)
    for width in (1, 7, 333):
        want = [values[i : i + width].min() for i in range(333 - width + 1)]
        assert sd.sliding_least(values, width).tolist() == want


@pytest.mark.parametrize("options", [{}, {"block_bytes": 700}])
def test_equals_brute_force(spark, options):
    rows = texts(120, 3)
    want = brute(rows, 48)
    assert any(r[3] > 1 for r in want) and any(r[2] == 0 < r[1] for r in want)
    assert found(spark, rows, 48, gram=12, **options) == want


def test_odd_texts(spark):
    rnd = random.Random(8)
    once = "".join(rnd.choices("abcdefgh é", k=400))
    rows = [
        (1, None), (2, ""), (3, "short"), (4, "a" * 9000), (5, once), (6, "xy" * 40), (7, "ab" * 300),
        (8, "q" + once[100:200] + "r"), (None, once[:90] + "!"), (9, "é" * 60), (10, "tail"),
    ]
    rows += [(11, "copy " * 3 + once[::-1]), (11, "copy " * 3 + once[::-1]), (None, None)]
    want = brute(rows, 60)
    assert found(spark, rows, 60, gram=16) == want
    assert found(spark, rows, 60, gram=16, block_bytes=100) == want
    assert found(spark, [], 60, gram=16) == []


def test_the_last_stretch_ends_before_any_other():
    # "b" at the end is a whole stretch here, and others begin alike.
    rnd = random.Random(7)
    for _ in range(400):
        part = "".join(rnd.choices("ab", k=rnd.randint(1, 30))).encode()
        data = part * rnd.randint(1, 6)
        length = rnd.randint(1, 9)
        got = sd.suffix_array(np.frombuffer(data, np.uint8), length)
        heads = sorted(data[i : i + length] for i in range(len(data)))
        assert [data[i : i + length] for i in got] == heads


def test_a_text_that_occurs_once_loses_nothing(spark):
    text = "".join(random.Random(2).choices("abcdefghijklmnop ", k=5000))
    got = {r[0]: r[2] for r in found(spark, [(1, text), (2, text[:399]), (3, text[4000:])], 400)}
    assert got == {1: 1000, 2: 0, 3: 1000}


def test_a_hot_passage_is_split(spark):
    rnd = random.Random(5)
    line = "".join(rnd.choices("abcdefgh ", k=70))
    rows = [
        (i, "".join(rnd.choices("abcdefgh ", k=40)) + line + "".join(rnd.choices("abcdefgh ", k=40)))
        for i in range(400)
    ]
    want = brute(rows, 64)
    assert found(spark, rows, 64, gram=16, block_bytes=5_000) == want
    assert all(r[2] >= 70 for r in want)


def test_extra_columns_stay(spark):
    rows = [(1, "x" * 50, b"k", 7, 8), (2, "y", None, 9, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", kept binary, key int, n_bytes int")
    cut, names = sd.without_repeats(docs, 24, gram=16)
    assert names["kept"] == "_kept" and names["n_bytes"] == "_n_bytes"
    assert sorted((r.doc_id, r.kept, r.key, r.n_bytes, r._kept, r.n_removed) for r in cut.collect()) == [
        (1, b"k", 7, 8, b"", 50),
        (2, None, 9, None, b"y", 0),
    ]


def test_lengths_are_checked(spark):
    docs = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        sd.without_repeats(docs, 40)
