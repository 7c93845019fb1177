from __future__ import annotations

from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import line_dedup as ld

SCHEMA = "doc_id long, text string"
LONG = "this line has more than twenty letters"


def brute(rows):
    """The rule, read literally; a row is a document."""
    white = " \t\n\x0b\x0c\r"
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

    def key(line):
        return line.strip(white).translate(upper)

    holders = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(doc_id)
    out = []
    for doc_id, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            k = key(line)
            ids = [h for h in holders[k] if h is not None]
            lower = doc_id is None or bool(ids) and doc_id < max(ids)
            if not (len(k) >= 20 and len(holders[k]) >= 3 and ids and lower):
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    rows = df.select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(((r[0], r[1], r[2], r[3] or "") for r in rows), key=str)


ROWS = [
    (1, f"{LONG}\nshort"),
    (2, f"  {LONG.upper()}\t\nown text of document two here\n{LONG}"),
    (3, f"{LONG}\n{LONG}\n\nend"),
    (4, None),
    (5, ""),
    (6, "ünïcödé zeile mit genau zwanzig zeichen\n" * 2),
    (7, "ünïcödé zeile mit genau zwanzig zeichen"),
    (8, "ünïcödé zeile mit genau zwanzig zeichen"),
    (None, LONG),
    (8, f"{LONG}\nrow with the same id"),
    (9, "x" * 300_000 + "\n" + LONG),
    (9, "x" * 300_000 + "\n" + LONG),
]


def test_dedup_equals_the_rule(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert result(ld.dedup_lines(docs, shards=3)) == brute(ROWS)


def test_nothing_in_nothing_out(spark):
    assert ld.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_columns_stay_whatever_their_names(spark):
    docs = spark.createDataFrame(
        [(1, LONG, 7, "a"), (2, LONG, 8, "b"), (3, LONG, 9, None)],
        "doc_id long, text string, n_lines int, drop_keys string",
    )
    out = ld.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "drop_keys", "_n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.n_lines, r.text) for r in out.collect()) == [
        (1, 7, ""), (2, 8, ""), (3, 9, LONG)
    ]


def test_deletion_undoes_insertion(spark):
    first = spark.createDataFrame([r for r in ROWS if r[0] != 3], SCHEMA)
    later = spark.createDataFrame([(3, ROWS[2][1]), (20, LONG), (21, "a new line that is long")], SCHEMA)
    before = ld.build(first, shards=2)
    more = ld.insert(before, later)
    after = ld.delete(more, later.select("doc_id"))

    def state(index):
        counts = {tuple(r) for r in index.counts.select("hi", "lo", "n_docs", "max_doc").collect()}
        filters = {r["shard"]: ld.CuckooFilters(r["filters"]) for r in index.filters.collect()}
        held = sum(int((t != 0).sum()) for f in filters.values() for t in f.tables)
        return counts, held

    assert state(after) == state(before)
    whole = ld.build(first.union(later), shards=2)
    assert state(more) == state(whole)
    left = ld.without_lines(first, ld.dropped_keys(after, after.references))
    assert result(left) == brute([r for r in ROWS if r[0] != 3])


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**32))
def test_filter_holds_all_that_was_put_in(n, seed):
    random = np.random.default_rng(seed)
    hi, lo = (random.integers(-(2**63), 2**63, n, np.int64) for _ in range(2))
    shard = ld.CuckooFilters()
    shard.insert(hi, lo)
    assert shard.contains(hi, lo).all()
    assert sum(int((t != 0).sum()) for t in shard.tables) == n
    half = n // 2
    shard.delete(hi[:half], lo[:half])
    assert shard.contains(hi[half:], lo[half:]).all()
    shard = ld.CuckooFilters(shard.blobs())
    shard.delete(hi[half:], lo[half:])
    assert not any(t.any() for t in shard.tables)


def test_equal_keys_fill_and_grow():
    hi, lo = np.full(40, 5, np.int64), np.full(40, 9, np.int64)
    shard = ld.CuckooFilters()
    shard.insert(hi, lo)
    assert shard.contains(hi, lo).all() and len(shard.tables) > 1


def test_few_false_positives():
    random = np.random.default_rng(1)
    hi, lo = (random.integers(-(2**63), 2**63, 20_000, np.int64) for _ in range(2))
    shard = ld.CuckooFilters()
    shard.insert(hi[:10_000], lo[:10_000])
    assert shard.contains(hi[10_000:], lo[10_000:]).mean() < 0.005


def test_other_limits(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], SCHEMA)
    out = ld.dedup_lines(docs, min_chars=1, min_docs=2)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, ""), (2, "a"), (3, "b")]


def test_deletion_past_one_table_loses_no_other_key():
    random = np.random.default_rng(4)
    hi, lo = (random.integers(-(2**63), 2**63, 200_000, np.int64) for _ in range(2))
    shard = ld.CuckooFilters()
    for part in (slice(0, 50_000), slice(50_000, 200_000)):
        shard.insert(hi[part], lo[part])
    assert len(shard.tables) > 1
    shard.delete(hi[100_000:], lo[100_000:])
    assert shard.contains(hi[:100_000], lo[:100_000]).all()
    whole = ld.CuckooFilters.of(hi, lo)
    assert len(whole.tables) == 1 and whole.contains(hi, lo).all()


def test_an_outgrown_shard_is_built_again(spark):
    def docs(first, last):
        data = [(i, f"{LONG} {i}") for i in range(first, last)]
        return spark.createDataFrame(data, SCHEMA)

    index = ld.insert(ld.build(docs(0, 40), min_docs=1, shards=2), docs(40, 400))
    for held in (400, 300):
        shards = [ld.CuckooFilters(r["filters"]) for r in index.filters.collect()]
        assert [len(f.tables) for f in shards] == [1, 1]
        assert sum(int((t != 0).sum()) for f in shards for t in f.tables) == held
        assert index.counts.count() == held
        index = ld.delete(index, docs(300, 400).select("doc_id"))


def test_rows_without_an_id_get_only_their_own_lines(spark):
    """Many rows without an id, and many that share one: a row's list is that of its text."""
    n = 100_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"),
        F.concat_ws(
            "\n",
            F.lit(LONG),
            F.concat(F.lit("a line that few rows have "), (F.col("id") % 20_000).cast("string")),
            F.concat(F.lit("own "), F.col("id").cast("string")),
        ).alias("text"),
    )
    last = spark.createDataFrame([(8, LONG)], SCHEMA)
    docs = rows.union(last).repartition(8)
    index = ld.build(docs, shards=4)
    drops = ld.dropped_keys(index, index.references)
    lists = drops.groupBy("doc_id", "text_hash").agg(F.countDistinct("hi", "lo").alias("n"))
    assert lists.agg(F.max("n")).first()[0] <= 2
    out = ld.without_lines(docs, drops)
    # Lines with id % 20000 are in five rows of one parity: those of id 7 keep them.
    got = {tuple(r) for r in out.groupBy("doc_id", "n_dropped").count().collect()}
    assert got == {(7, 1, n // 2), (None, 1, n // 2), (8, 0, 1)}


def test_deletion_counts_only_what_goes(spark):
    """Deleting the keeper leaves the next largest id, deleting another only lowers the count."""
    docs = spark.createDataFrame([(i, f"{LONG}\n{LONG} {i % 3}") for i in range(1, 13)], SCHEMA)
    index = ld.build(docs, min_docs=3, shards=4)
    for gone in ([12], [3, 99], [11, 10, None], list(range(1, 8)), [8, 9]):
        ids = spark.createDataFrame([(i,) for i in gone], "doc_id long")
        index = ld.delete(index, ids)
        docs = docs.join(ids, "doc_id", "left_anti")
        whole = ld.build(docs, min_docs=3, shards=4)
        names = ["hi", "lo", "n_docs", "max_doc"]
        assert {tuple(r) for r in index.counts.select(names).collect()} == {
            tuple(r) for r in whole.counts.select(names).collect()
        }
        left = ld.without_lines(docs, ld.dropped_keys(index, index.references))
        assert result(left) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_sql_takes_a_row_as_a_document(spark, tmp_path):
    """Rows that share a doc_id, or have none, count alike in the operator and its SQL."""
    import duckdb

    from riskloom.llm.oracle import STATEMENTS
    from riskloom.llm.queries import QUERIES

    rows = [(1, LONG), (1, LONG), (2, f"{LONG}\nx"), (None, LONG), (2, LONG), (None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op3_line_dedup"](spark, str(tmp_path))
    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({STATEMENTS['op3_line_dedup']})").fetchall()
    assert sorted((tuple(r) for r in found.select(names).collect()), key=str) == sorted(expected, key=str)
    assert sum(r[2] for r in expected) == 3
