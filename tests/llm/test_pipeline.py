"""The pipeline against its stages composed by brute force."""

from __future__ import annotations

import importlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_line_dedup import brute as brute_lines
from test_near_dedup import brute as brute_near
from test_quality_rules import brute_counts

import corpus_pipeline as cp
from riskloom.llm import mixing
from riskloom.llm.queries import tokenizer_path
from riskloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """What each stage returned, read again after it was written."""
    docs = cp.table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_order_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == [
        "quality_rules", "line_dedup", "minhash_near_dedup", "mixing", "packing"
    ]
    assert all(df.columns == COLUMNS for df in steps[:5])


def test_quality_stage(steps):
    before, after = rows(steps[0]), rows(steps[1])
    kept = {r[0] for r in after}
    assert after == [r for r in before if r[0] in kept]
    for doc_id, text, *_ in before:
        n_words, _, _, _, repeated = brute_counts(text)
        if n_words < 50 or 100 * repeated > 50 * n_words:
            assert doc_id not in kept
    votes = Counter(doc_id in kept for doc_id, *_ in before)
    assert votes[True] > votes[False]


def test_line_stage(steps):
    before, after = rows(steps[1]), rows(steps[2])
    want = brute_lines([(r[0], r[1]) for r in before])
    assert [(r[0], r[1]) for r in after] == sorted((d, t) for d, _, _, t in want)
    assert all(r[4] == len(r[1]) for r in after)
    assert any(r[2] for r in want)


def test_near_stage(steps):
    before, after = rows(steps[2]), rows(steps[3])
    kept = {d for d, _, _, k in brute_near([(r[0], r[1]) for r in before], 5) if k}
    assert after == [r for r in before if r[0] in kept]
    assert len(after) < len(before)


def topic(text):
    marks = Counter(text)
    if marks["|"] >= 5:
        return "table"
    if marks["!"] >= 5:
        return "loud"
    if marks["#"] + marks["%"] + marks["$"] >= 5:
        return "symbols"
    if re.search("[0-9]", text):
        return "numbers"
    return "long form" if marks["\n"] >= 5 else "short form"


def test_mixing_stage(steps):
    import hashlib

    from test_mixing import MARGINS, plain_ipf, tempered

    before, after = rows(steps[3]), rows(steps[4])
    data = [(r[0], r[3], r[2], topic(r[1]), len(r[1].encode().split())) for r in before]
    wants = {m: tempered(data, i + 1, mixing.TEMPER) for i, m in enumerate(MARGINS)}
    chance = plain_ipf(data, wants, mixing.SWEEPS)
    kept = set()
    for r in data:
        drawn = int(hashlib.md5(f"{mixing.SEED}/{r[0]}".encode()).hexdigest()[:8], 16) / 2**32
        if drawn < round(chance[r[1:4]], 6):
            kept.add(r[0])
    assert after == [r for r in before if r[0] in kept]
    assert 0 < len(after) < len(before)


def test_packing_stage(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = {r[0]: r[1] for r in rows(steps[4])}
    by_doc, ends = defaultdict(list), defaultdict(list)
    for r in steps[5].collect():
        by_doc[r.doc_id].append(r)
        ends[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(ids))
            at += r.length
        assert at == len(ids)
    for pieces in ends.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_equals_the_stages(spark, sf_dir, steps):
    def key(df):
        return sorted(tuple(r) for r in df.select("doc_id", "start", "ids_crc32").collect())

    assert key(cp.run(spark, sf_dir)) == key(steps[5])


def odd_documents(spark):
    good = " ".join(f"word{i}" for i in range(80))
    data = [
        (1, good, "en", "a", 3, "x"), (1, good, "en", "a", 3, "x"), (2, None, None, None, None, "x"),
        (3, "", "en", "a", 0, None), (None, good + " more", "en", None, 1, "x"),
        (4, good.replace("word", "Wort"), "de", "b", 2, "x"), (5, "w " * 60_000, "en", "a", 1, "x"),
        (6, good + "\n" + " ".join(f"other{i}" for i in range(70_000)), "en", "a", 1, "x"),
    ]
    return spark.createDataFrame(
        data,
        "doc_id long, text string, lang string, source string, n_chars long, kept string",
    )


@pytest.mark.parametrize("name,stage", cp.STAGES, ids=[n for n, _ in cp.STAGES])
def test_stages_take_odd_documents(spark, sf_dir, name, stage):
    docs = odd_documents(spark)
    out = materialize(stage(spark, docs, sf_dir), f"odd-{name}")
    assert out.count() > 0
    if name != "packing":
        assert out.columns == docs.columns
    empty = materialize(stage(spark, docs.limit(0), sf_dir), f"none-{name}")
    assert empty.count() == 0


def test_nothing_else_needs_the_operators(monkeypatch):
    """Without the operators the other queries are still registered."""
    import sys

    for name in [m for m in sys.modules if m.startswith(("riskloom.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name.startswith(("riskloom.llm", "corpus_pipeline")):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    assert "risk_score" in entry.queries() and not any(n.startswith("op") for n in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
