"""Token counts under a unigram vocabulary, by dynamic programming along a trie.

Texts are split into pre-tokens at white space. The distinct pre-tokens of a batch are put
into a trie (sorted, so that a node's words stand together), and the best scores of their
segmentations are computed once for each node: a word that shares a prefix with the one
before goes on from the scores of that prefix. Terminal nodes store the number of tokens,
and a document's count is the sum over its pre-tokens.

The best segmentation has the highest sum of scores, and of those the fewest tokens, so a
count does not depend on how ties are broken. A character that no piece covers counts as
one token per UTF-8 byte, below every score of the vocabulary.

Defined cases: a null text, an empty one, and one of white space have no tokens. Words are
remembered up to a limit; longer words than a limit of bytes are scored but not remembered.
Rows are documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.llm.common import MEMO_LIMIT, add_by_text, fresh

MARK = "▁"
LONG_WORD = 256
RANK_SHIFT = 2.7


def vocabulary(path: str) -> dict[str, float]:
    """The pieces of a sentence-piece file and the logarithms of their probabilities.

    Control and byte pieces are left out. A unigram file has the logarithms; the scores of a file
    of merges are whole numbers that fall with the rank, from which rank_law makes them.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    return rank_law(scores) if all(s == int(s) for s in scores.values()) else scores


def rank_law(scores: dict[str, float]) -> dict[str, float]:
    """Logarithms of probabilities that fall as 1 / (rank + RANK_SHIFT) and sum to one.

    Frequencies of words follow such a law; merges are ranked by the frequency of what they make.
    Equal scores share a rank.
    """
    ranks = {s: i + 1 for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
    weights = {piece: 1 / (ranks[s] + RANK_SHIFT) for piece, s in scores.items()}
    total = math.log(math.fsum(weights.values()))
    return {piece: math.log(w) - total for piece, w in weights.items()}


class TrieCounter:
    """Scores pre-tokens; keeps the counts of those it has seen."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.counts: dict[bytes, int] = {}
        self.nodes = 0

    def forget(self) -> None:
        if len(self.counts) > MEMO_LIMIT:
            self.counts.clear()

    def learn(self, words: Iterable[bytes]) -> None:
        """Counts for words not seen yet, in the order of a walk through their trie."""
        before, best = "", [(0.0, 0)]
        for text, word in sorted((MARK + w.decode(), w) for w in words):
            shared = 0
            limit = min(len(before), len(text))
            while shared < limit and before[shared] == text[shared]:
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                best.append(self._forward(text, end, best))
            self.nodes += len(text) - shared
            self.counts[word] = -best[-1][1]
            before = text

    def _forward(self, text: str, end: int, best: list[tuple[float, int]]) -> tuple[float, int]:
        """The best (score, minus tokens) of the prefix that ends here."""
        pieces, top = self.pieces, None
        for start in range(max(0, end - self.longest), end):
            score = pieces.get(text[start:end])
            if score is not None:
                found = (best[start][0] + score, best[start][1] - 1)
                if top is None or found > top:
                    top = found
        if text[end - 1] not in pieces:
            size = len(text[end - 1].encode())
            found = (best[end - 1][0] + size * self.unknown, best[end - 1][1] - size)
            if top is None or found > top:
                top = found
        return top

    def long(self, word: bytes) -> int:
        """The count of a long word, from a window of the last scores; not remembered."""
        text, best = MARK + word.decode(), [(0.0, 0)]
        for end in range(1, len(text) + 1):
            start = max(0, end - self.longest)
            best = best[-(end - start) :]
            best.append(self._forward(text[start:end], end - start, best))
        return -best[-1][1]

    def of(self, words: list[bytes]) -> int:
        counts = self.counts
        return sum(counts[w] if len(w) <= LONG_WORD else self.long(w) for w in words)


_LOADED: dict[str, TrieCounter] = {}


def counter(path: str) -> TrieCounter:
    """One trie counter per worker process."""
    if path not in _LOADED:
        _LOADED[path] = TrieCounter(vocabulary(path))
    return _LOADED[path]


def with_token_counts(docs: DataFrame, path: str) -> DataFrame:
    """docs with n_pretokens and n_tokens (under unused names)."""
    words_name, tokens_name = fresh(docs, "n_pretokens", "n_tokens")

    def make(texts: Iterable[bytes | None]) -> dict[str, list]:
        known = counter(path)
        n_words, n_tokens, held, size = [], [], [], 0

        def flush():
            distinct = {w for w in set().union(*held) if len(w) <= LONG_WORD}
            known.forget()
            known.learn(distinct.difference(known.counts))
            n_tokens.extend(map(known.of, held))
            held.clear()

        for text in texts:
            words = (text or b"").split()
            n_words.append(len(words))
            held.append(words)
            size += len(text or b"")
            if size > 1 << 23:
                flush()
                size = 0
        flush()
        return {words_name: n_words, tokens_name: n_tokens}

    fields = [T.StructField(n, T.LongType()) for n in (words_name, tokens_name)]
    return add_by_text(docs, "text", fields, make)
