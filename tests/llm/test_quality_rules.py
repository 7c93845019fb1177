from __future__ import annotations

import re
from collections import Counter

import numpy as np
from conftest import duck_on
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import quality_rules as qr
from riskloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #*|\n\té中!A", max_size=120))
def test_counts_equal_brute_force(text):
    assert qr.text_counts(text.encode())[:5] == brute_counts(text)


def naive_em(votes, rounds):
    """EM with a document at a time and plain loops."""
    n, rules = len(votes), len(votes[0])
    good = [0.1 if 2 in v else 0.95 for v in votes]
    for _ in range(rounds):
        share = sum(good) / n
        rate = {}
        for c in (0, 1):
            of = [g if c else 1 - g for g in good]
            for r in range(rules):
                held = [sum(o for o, v in zip(of, votes) if v[r] == x) / n + 1 / (3 * (n + 1)) for x in range(3)]
                for x in range(3):
                    rate[c, r, x] = held[x] / sum(held)
        new = []
        for v in votes:
            one, zero = share, 1 - share
            for r in range(rules):
                one *= rate[1, r, v[r]]
                zero *= rate[0, r, v[r]]
            new.append(one / (one + zero))
        good = new
    return good


def test_em_equals_a_plain_version():
    random = np.random.default_rng(3)
    truth = random.random(400) < 0.8
    p = np.where(truth[:, None, None], [[[0.2, 0.75, 0.05]]], [[[0.4, 0.2, 0.4]]])
    votes = (random.random((400, 6, 1)) > p.cumsum(axis=2)[:, :, :2] * np.ones((1, 6, 1))).sum(axis=2)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, rates = qr.estimate(patterns, counts.astype(float))
    mine = qr.posterior(patterns, share, rates)[inverse]
    plain = np.array(naive_em([tuple(v) for v in votes], 200))
    assert np.abs(mine - plain).max() < 0.02
    assert ((mine > 0.5) == truth).mean() > 0.9


def judged(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    counted, names = qr.with_counts(docs)
    return qr.judged(counted, names)[0]


def _word(i):
    return "".join("abcdefghij"[int(d)] for d in f"{i:03d}") + "el"


GOOD = " ".join(_word(i).capitalize() if i % 9 == 0 else _word(i) for i in range(120)) + "."
BAD = " ".join(f"{_word(i).upper()}!!" for i in range(120))
TABLE = " | ".join(_word(i) for i in range(100))


def test_verdicts(spark):
    rows = [(i, GOOD + " " + _word(200 + i)) for i in range(60)]
    rows += [(100 + i, BAD + " " + _word(200 + i)) for i in range(5)]
    rows += [(110 + i, TABLE + " " + _word(200 + i)) for i in range(5)]
    rows += [(200, None), (201, ""), (202, "few words"), (203, "again and again " * 40)]
    out = {r.doc_id: r for r in judged(spark, rows).collect()}
    assert all(out[i].kept and not out[i].base_failed for i in range(60))
    assert not any(out[i].kept or out[i].base_failed for i in [*range(100, 105), *range(110, 115)])
    assert all(out[i].base_failed and not out[i].kept for i in (200, 201, 202, 203))


def test_one_document_repeated_rows_and_no_documents(spark):
    assert [r.kept for r in judged(spark, [(1, GOOD)]).collect()] == [True]
    rows = judged(spark, [(1, GOOD), (1, GOOD), (None, GOOD), (2, GOOD + " x" * 50_000)]).collect()
    assert len(rows) == 4
    assert judged(spark, []).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, GOOD, "a", "b")], SCHEMA + ", n_words string, kept string")
    counted, names = qr.with_counts(docs)
    out, made = qr.judged(counted, names)
    row = out.first()
    assert (row["n_words"], row["kept"]) == ("a", "b")
    assert (names["n_words"], made["kept"]) == ("_n_words", "_kept")
    assert row["_n_words"] == brute_counts(GOOD)[0] and row["_kept"]


def test_query_counts_and_labels(spark, sf_dir):
    con = duck_on(sf_dir)
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    quality = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    con.close()
    rows = QUERIES["op2_quality_rules"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        counts = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.kept and r.base_failed)
    judged = [(r.kept, quality[r.doc_id]) for r in rows if r.doc_id in quality and not r.base_failed]
    assert sum(kept == bool(q) for kept, q in judged) >= 0.97 * len(judged)
