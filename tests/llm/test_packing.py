from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import duck_on
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import packing as pk
from riskloom.llm.queries import QUERIES, tokenizer_path

SCHEMA = "doc_id long, text string"
PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


ODD = [
    "", " ", "It's I'LL don't <|endoftext|>x <|ENDOFTEXT|> 'S 'Re, x'ss 12a3 ½ ﬁ",
    "áb É…! İ ΑΣ ΑΣ, \x1c\x85 q\x00z “quote” a≮ naïve, ß. ẃ", "x" * 9000, "\n\t\r",
    "a<|startoftext|>b, <|x", "中文字 text。 Ⅷ ⅷ", "e.g., (this) [that]... --- !!??",
]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_tokenizers(text):
    text = "".join(c for c in text if not 0xD800 <= ord(c) < 0xE000)
    known = pk.word_ids(PATH)
    want = known.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(known.of(text.encode()), "<u4").tolist() == want


def check(rows, texts, tokenizer, length):
    """Each id of each text once, gapless sequences, and checksums."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(ids))
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
    return len(by_sequence)


def test_pack_edge_cases(spark, tokenizer):
    texts = dict(enumerate([*ODD, None, "word " * 5000]))
    docs = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(3)
    check(pk.pack_documents(docs, PATH, 64).collect(), texts, tokenizer, 64)


def test_query_is_whole_and_dense(spark, sf_dir, tokenizer):
    con = duck_on(sf_dir)
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    con.close()
    rows = QUERIES["op4_packing"](spark, sf_dir).collect()
    sequences = check(rows, texts, tokenizer, 2048)
    tokens = sum(r.length for r in rows)
    assert sequences <= 1.02 * tokens / 2048 + 2


def test_ids_come_with_the_pieces(spark, tokenizer):
    docs = spark.createDataFrame([(1, "hello world"), (2, None)], SCHEMA)
    rows = pk.pack_documents(docs, PATH, ids=True).orderBy("doc_id").collect()
    want = [*tokenizer.encode("hello world", add_special_tokens=False).ids, 1]
    assert np.frombuffer(bytes(rows[0].ids), "<u4").tolist() == want
    assert np.frombuffer(bytes(rows[1].ids), "<u4").tolist() == [1]


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "c"), (4, "c")], SCHEMA)
    rows = pk.pack_documents(docs, PATH).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert pk.pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_groups_do_not_follow_from_keys(spark):
    docs = spark.createDataFrame([(1, "same text")] * 400, SCHEMA)
    rows = pk.pack_documents(docs, PATH, group_size=50).collect()
    assert len({r.sequence_id >> 32 for r in rows}) == 8


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing(sizes):
    bins, offsets = pk.first_fit_decreasing(sizes, 50)
    free, want = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        want[i] = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
        if want[i] == len(free):
            free.append(50)
        assert offsets[i] == 50 - free[want[i]]
        free[want[i]] -= sizes[i]
    assert bins == want
