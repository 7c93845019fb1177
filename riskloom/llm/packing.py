"""Packing documents into sequences of a fixed number of tokens.

Every document is tokenised where it lies and cut into pieces of a full sequence, the rest
being a shorter last piece. Only the pieces' lengths are shuffled. They are dealt at random
into groups of a bounded size, and each group is packed by itself, first fit decreasing:
a tournament tree over the free space of the bins finds the first bin that is large enough.

A white-space separated word has the same ids wherever it stands: the tokenizer removes
white space, its patterns cannot match across it, and canonical composition does not cross
it. So ids are remembered by word.

Defined cases: a null text is empty, an empty text is the end id alone. Rows are documents;
repeated rows and null ids are packed like others. No documents give no pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import MEMO_LIMIT, byte_values
from riskloom.session import materialize

LENGTH = 2048
END_ID = 1
GROUP_SIZE = 2048
SEED = 20

# Letters whose lower case and canonical form are themselves: one pre-token, whatever follows.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
# Between an ASCII letter and ASCII punctuation there is always a border of pre-tokens.
_TAIL = re.compile(rb"^(.*[a-z])([!-/:-@\[-`{-~]+)$", re.DOTALL)


def _byte_letters() -> list[str]:
    """The letter for each byte in byte-level vocabularies: itself if it can be printed."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class WordIds:
    """Ids of words as little-endian unsigned 32-bit values, remembered up to a limit."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.known: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(_byte_letters()))
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.packed = [i.to_bytes(4, "little") for i in range(size)]

    def _ids(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha() and word.islower():
            ids = [t.id for t in self.tokenize(text)]
        elif _PLAIN.fullmatch(text):
            ids = [t.id for t in self.tokenize(word.decode("latin-1").translate(self.letters))]
        elif b"<|" not in word and (tail := _TAIL.match(word)):
            return self._known(tail[1]) + self._known(tail[2])
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self.packed[i] for i in ids])

    def _known(self, word: bytes) -> bytes:
        if word not in self.known:
            self.known[word] = self._ids(word)
        return self.known[word]

    def of(self, text: bytes) -> bytes:
        known = self.known
        if len(known) > MEMO_LIMIT:
            known.clear()
        if b"<|" in text:  # special tokens are read before anything is lower-cased
            words = [w if b"<|" in w else w.lower() for w in text.split()]
        else:
            words = text.lower().split()
        for word in set(words).difference(known):
            known[word] = self._ids(word)
        return b"".join(map(known.get, words))


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids as bytes."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    step = 4 * length
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        for batch in batches:
            owner, start, size, crc, total, parts = [], [], [], [], [], []
            for row, text in enumerate(byte_values(batch.column(1))):
                own = known.of(text or b"") + end
                for at in range(0, len(own), step):
                    part = own[at : at + step]
                    owner.append(row)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(own) // 4)
                    if ids:
                        parts.append(part)
            columns = [batch.column(0).take(pa.array(owner, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
            columns += [pa.array(parts, pa.binary())] * ids
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *["ids"] * ids])

    schema = ", ".join(f"{n} long" for n in names) + ", ids binary" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class TournamentTree:
    """Free space of bins; each inner node holds the larger of its two children."""

    def __init__(self, bins: int, length: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [length] * (2 * self.leaves)

    def take(self, size: int) -> int:
        """Put so much into the first bin that has room, and return its number."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        free[node] -= size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
        return bin_


def first_fit_decreasing(sizes: list[int], length: int) -> tuple[list[int], list[int]]:
    """The bin and the offset of each size, in the order given."""
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    tree, used = TournamentTree(len(sizes), length), {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bins[i] = tree.take(sizes[i])
        offsets[i] = used.get(bins[i], 0)
        used[bins[i]] = offsets[i] + sizes[i]
    return bins, offsets


def pack(
    cut: DataFrame, length: int = LENGTH, group_size: int = GROUP_SIZE, seed: int = SEED
) -> DataFrame:
    """Pieces (any columns, among them length) with sequence_id and offset.

    cut has to be a written table: the random group of a row follows from its place there,
    so a task that is computed again deals its rows alike, and no key decides a group.
    """
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

    groups = max(1, round(cut.count() / group_size))
    dealt = cut.withColumn("pack_group", F.floor(F.rand(seed) * groups).cast("long"))
    out = to_arrow_schema(cut.schema)
    out = out.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))

    def run(group: pa.Table) -> pa.Table:
        order = [(n, "ascending") for n in ("doc_id", "start") if n in group.column_names]
        group = group.sort_by(order) if order else group
        bins, offsets = first_fit_decreasing(group["length"].to_pylist(), length)
        first = group["pack_group"][0].as_py() << 32
        group = group.drop_columns(["pack_group"])
        group = group.append_column("sequence_id", pa.array([first + b for b in bins], pa.int64()))
        return group.append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("pack_group").applyInArrow(run, from_arrow_schema(out))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    group_size: int = GROUP_SIZE,
    ids: bool = False,
) -> DataFrame:
    """Documents tokenised, cut and packed."""
    cut = materialize(pieces(docs, tokenizer, length, end_id, ids), "pack-pieces")
    return pack(cut, length, group_size)
