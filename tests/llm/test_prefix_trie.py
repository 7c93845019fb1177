from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from riskloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = (
    "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    convs = rebuilt(rows)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, inside in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(inside) - 1) * (len(path[-1][1]) if path else 0)
    out = []
    for path, inside in members.items():
        ends = ",".join(str(c) for c in inside if len(convs[c]) == len(path))
        out.append(
            (
                inside[0],
                len(path),
                members[path[:-1]][0] if path else None,
                len(inside),
                children.get(path, 0),
                leaves[path],
                saved[path],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: r[:2])


def found(spark, rows, **limits):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    turns, lengths = prefix_trie.stitched(prefix_trie.ordered(docs))
    nodes = prefix_trie.trie(turns, lengths, **limits)
    assert nodes.columns == COLUMNS
    return sorted((tuple(r) for r in nodes.collect()), key=lambda r: r[:2])


def conversations(n, most, seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rnd.randint(1, most)):
            text = rnd.choice(["hi", "yes", "no é", ""]) if rnd.random() < 0.8 else str(c)
            rows.append((c, turn, "user" if turn % 2 else "assistant", text))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "limits", [{}, {"shard_units": 3, "span": 2}, {"shard_turns": 7, "span": 4}]
)
def test_equals_brute_force(spark, limits):
    rows = conversations(220, 8, 5)
    assert found(spark, rows, **limits) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "user", "a"),
        (1, 0, "user", "a"),  # repeated
        (1, 0, "assistant", "b"),  # tie: role decides
        (None, 1, "user", "nobody"),
        (205, 1, "user", "x" * 300_000),  # base is absent
        (-3, 1, "user", None),
        (300, 7, "", ""),
        (301, 1, "user", ""),
        (2**62, 1, "user", "far"),
        (4, 1, "user", "one, two"),
        (5, 1, "user, one", "two"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(None, 1, "user", "nobody")]) == []


def test_extra_columns_are_not_read(spark):
    rows = [(7, 1, "user", "a", 1, 2), (8, 1, "user", "a", 3, 4)]
    docs = spark.createDataFrame(rows, SCHEMA + ", depth int, position int")
    turns, lengths = prefix_trie.stitched(prefix_trie.ordered(docs))
    assert prefix_trie.trie(turns, lengths).count() == len(brute([r[:4] for r in rows]))


def test_a_hot_conversation_and_a_hot_first_turn(spark):
    rows = [(0, t, "user", str(t % 7)) for t in range(200)]
    rows += [(100 * c, t, "user", f"{t * (c % 50)}") for c in range(1, 120) for t in range(4)]
    assert found(spark, rows, span=32, shard_units=16) == brute(rows)


def test_many_copies_end_in_one_node(spark):
    rows = [(100 * c, 0, "user", "same") for c in range(1500)] + [(100, 1, "user", "more")]
    got = found(spark, rows, shard_units=700)
    assert got == brute(rows)
    assert [r[3] for r in got] == [1500, 1500, 1]


def test_positions_go_on_across_tasks(spark):
    rows = [(1, t, "user", str(t)) for t in range(4000)] + [(2, None, "b", "c")]
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
        out = prefix_trie.ordered(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert sorted(r.position for r in out if r.conv_id == 1) == list(range(1, 4001))
    assert [r.position for r in out if r.conv_id == 2] == [1]
