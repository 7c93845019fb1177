"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at a few counts of a document and votes keep, reject, or not at all. How
often a rule votes either way on good and on bad documents is estimated by expectation
maximisation from the votes alone. The votes of a document are one of at most 3 ** rules
patterns, so EM works on the counts of the patterns, a table that does not grow with the
corpus. A document's probability to be good replaces the demand to pass every rule.

Defined cases: a null or empty text has no words, all its counts are 0 and it fails the
base test; the rules abstain. Rows are documents. Of an empty table nothing is learned and
nothing returned; where every document fails the base test, all qualities are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import WHITE, WORDS, add_by_text, fresh, windows

SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()
DIGITS = b"0123456789"
CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_unique_words",
    "n_lines",
    "n_marks",
    "n_upper",
    "n_letters",
    "n_bare_symbols",
)
ITERATIONS = 100
TOLERANCE = 1e-9


def repeated_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words in windows of so many words that occur twice or more, the first included."""
    if len(hashes) < size:
        return 0
    grams = windows(hashes, size)
    order = np.argsort(grams, kind="stable")
    equal = grams[order][1:] == grams[order][:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(len(hashes), bool)
    for i in range(size):
        covered[i : i + len(grams)] |= twice
    return int(covered.sum())


def _without(text: bytes, these: bytes) -> int:
    return len(text) - len(text.translate(None, these))


def text_counts(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    seen, repeated, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(WHITE):
            lines += 1
            repeated += line in seen
            seen.add(line)
    hashes = WORDS.of(words)
    chars = len(text.translate(None, WHITE + CONTINUATION))
    other = len(text.translate(None, bytes(range(0x80)) + CONTINUATION))
    symbols = _without(text, SYMBOLS)
    bare = sum(words.count(bytes([symbol])) for symbol in SYMBOLS) if symbols else 0
    return (
        len(words),
        chars,
        symbols,
        repeated,
        repeated_words(hashes),
        len(np.unique(hashes)),
        lines,
        _without(text, b"!"),
        _without(text, UPPER),
        _without(text, LETTERS) + other,
        bare,
    )


def with_counts(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with the counts, and the (unused) names these columns got."""
    names = fresh(docs, *COUNTS)

    def make(texts: Iterable[bytes | None]) -> dict[str, list]:
        rows = [text_counts(t) for t in texts]
        return {n: [r[i] for r in rows] for i, n in enumerate(names)}

    fields = [T.StructField(n, T.LongType()) for n in names]
    return add_by_text(docs, "text", fields, make), dict(zip(COUNTS, names))


def base_failed(c: dict[str, Column]) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def rules(c: dict[str, Column]) -> dict[str, Column]:
    """1 keep, 2 reject, 0 abstain. Where the denominator is 0, nothing compares: abstain."""

    def vote(reject: Column, keep: Column | None = None) -> Column:
        out = F.when(reject, 2)
        return (out if keep is None else out.when(keep, 1)).otherwise(0)

    words = F.when(c["n_words"] > 0, c["n_words"])
    lines = F.when(c["n_lines"] > 0, c["n_lines"])
    letters = F.when(c["n_letters"] > 0, c["n_letters"])
    chars = F.when(c["word_chars"] > 0, c["word_chars"])
    length = chars / words
    return {
        "symbols": vote(c["n_symbols"] / words > 0.1, c["n_symbols"] / words < 0.01),
        "bare_symbols": vote(c["n_bare_symbols"] / words > 0.1, c["n_bare_symbols"] / words < 0.01),
        "shouting": vote(c["n_upper"] / letters > 0.3, c["n_upper"] / letters < 0.1),
        "marks": vote(c["n_marks"] / words > 0.1),
        "dup_lines": vote(c["n_dup_lines"] / lines > 0.5),
        "repeats": vote(c["n_repeat_words"] / words > 0.3, c["n_repeat_words"] / words < 0.15),
        "word_length": vote((length < 2) | (length > 12), length.between(3, 8)),
        "variety": vote(c["n_unique_words"] / words < 0.1),
        "letters": vote(c["n_letters"] / chars < 0.6, c["n_letters"] / chars > 0.75),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """The share of good documents and, per class (bad, good), rule and vote, its probability.

    patterns: votes per rule, a row per distinct pattern. Starts from the view that a
    document with a reject is probably bad.
    """
    hot = np.eye(3)[patterns]
    good = np.where((patterns == 2).any(axis=1), 0.1, 0.95)
    weight = counts / counts.sum()
    before = -np.inf
    for _ in range(ITERATIONS):
        share, rates = _maximised(hot, weight, good, counts.sum())
        joint = _joint(hot, share, rates)
        top = joint.max(axis=1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(joint - top).sum(axis=1))
        good = np.exp(joint[:, 1] - total)
        fit = float((weight * total).sum())
        if fit - before < TOLERANCE:
            break
        before = fit
    return share, rates


def _maximised(hot, weight, good, n) -> tuple[float, np.ndarray]:
    """Rates of either class from the present probabilities, one document added to each."""
    share = float((weight * good).sum())
    share = min(max(share, 1e-6), 1 - 1e-6)
    rates = []
    for of_class in (1 - good, good):
        held = (weight * of_class)[:, None, None] * hot
        rate = held.sum(axis=0) + 1 / (3 * (n + 1))
        rates.append(rate / rate.sum(axis=1, keepdims=True))
    return share, np.array(rates)


def _joint(hot: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    return np.stack(
        [
            np.log(prior) + np.einsum("prv,rv->p", hot, np.log(rate))
            for prior, rate in zip((1 - share, share), rates)
        ],
        axis=1,
    )


def posterior(patterns: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    joint = _joint(np.eye(3)[patterns], share, rates)
    return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -700, 700)))


def _digits(code: np.ndarray, n: int) -> np.ndarray:
    return (code[:, None] // 3 ** np.arange(n)) % 3


def judged(counted: DataFrame, names: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """counted with base_failed, quality (the probability to be good) and kept."""
    out = dict(zip(("quality", "base_failed", "kept"), fresh(counted, "quality", "base_failed", "kept")))
    c = {k: F.col(v) for k, v in names.items()}
    votes = list(rules(c).values())
    (pattern,) = fresh(counted, "vote_pattern")
    code = sum((v * 3**i for i, v in enumerate(votes)), F.lit(0)).cast("long")
    voted = counted.withColumn(pattern, code)
    # At most 3 ** rules rows, however many documents there are. Documents that fail the base
    # test are decided and teach nothing.
    usable = F.count_if(~base_failed(c)).alias("usable")
    found = sorted((r[0], r[1]) for r in voted.groupBy(pattern).agg(usable).collect())
    rows = []
    if found:
        codes, counts = (np.array(x) for x in zip(*found))
        patterns = _digits(codes, len(votes))
        seen = counts > 0
        quality = np.full(len(codes), 0.5)
        if seen.any():
            model = estimate(patterns[seen], counts[seen].astype(float))
            quality = posterior(patterns, *model)
        rows = [(int(k), float(q)) for k, q in zip(codes, quality)]
    known = counted.sparkSession.createDataFrame(rows, f"{pattern} long, {out['quality']} double")
    scored = voted.join(F.broadcast(known), pattern, "left").drop(pattern)
    failed = base_failed(c)
    return scored.withColumns(
        {out["base_failed"]: failed, out["kept"]: ~failed & (F.col(out["quality"]) >= 0.5)}
    ), out
