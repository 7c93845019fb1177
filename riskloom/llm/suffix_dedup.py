"""Removal of long repeated byte strings by suffix arrays.

1. Every window of `length` bytes of a text is put under the least hash of the grams in it. Equal
   windows have the same least hash, so they meet, wherever they are; successive windows with the
   same one are a segment, some hundred bytes long. Segments are counted by digest, so copies cost
   a row each and no text.
2. A segment that occurs twice is repeated as a whole. One that occurs once is looked at only if
   other segments share its hash (or its hash occurs twice in it); the bytes of one of each kind
   are sent to blocks of some megabytes, all segments of a hash to the same block.
3. A block's suffix array is made in two stages: suffixes smaller than their successors are sorted
   directly (by the stretches between them, then by doubling), all others are induced by one scan
   over the buckets of first bytes. Windows whose common prefix with a neighbour in the array
   reaches `length` are repeated.
4. A hash with more segments than a block holds, as a line in a third of all documents has, is
   split by the digest of each window instead of being sent to one task; nothing is left out.
5. Repeated windows go back to their texts as spans, which are merged and cut out.

The array is in order by the first `length` bytes at least, which is all that is asked of it.

Defined cases: a null text is empty; texts of fewer than `length` bytes lose nothing, but a string
may repeat within one text. Rows with equal texts are copies of each other, also under the same
doc_id or without one. What is left of a text are bytes: a cut may go through a character. An
empty table gives an empty one. Extra columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import byte_values, fresh, mixed, text_or_empty
from riskloom.session import materialize

LENGTH = 400
GRAM = 64
BLOCK = 1 << 20
LONGEST = 4096
SEED = 12
SEGMENT = ["a", "s"]


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    out = []
    for factor in (base, inverse):
        values = np.full(size, factor, np.uint64)
        values[0] = 1
        out.append(np.multiply.accumulate(values))
    return out[0], out[1]


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash per gram of so many bytes, from sums over the text before its two ends."""
    random = np.random.default_rng(SEED).integers(0, 2**63, 256, np.uint64)
    powers, inverses = _powers(1 << max(12, len(data).bit_length()))
    sums = np.cumsum(random[data] * powers[: len(data)], dtype=np.uint64)
    inside = sums[size - 1 :].copy()
    inside[1:] -= sums[:-size]
    return mixed(inside * inverses[: len(inside)])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each window, from the least values up to and from the borders of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, 2**64 - 1, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:count], up[width - 1 : width - 1 + count])


def text_segments(data: np.ndarray, length: int, gram: int) -> list[tuple[int, int, int, bool]]:
    """(first window, windows, least hash, whether the hash occurs twice) of each segment."""
    if len(data) < length:
        return []
    hashes = gram_hashes(data, gram)
    least = sliding_least(hashes, length - gram + 1)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    sizes = np.diff(np.r_[starts, len(least)])
    if sizes.max() > LONGEST:
        pieces = [range(s, s + n, LONGEST) for s, n in zip(starts.tolist(), sizes.tolist())]
        starts = np.array([at for piece in pieces for at in piece])
        sizes = np.diff(np.r_[starts, len(least)])
    values = least[starts]
    distinct = np.unique(values)
    alone = np.isin(hashes, distinct).sum() == len(distinct)
    out = []
    for at, n, value in zip(starts.tolist(), sizes.tolist(), values):
        twice = not alone and (hashes[at : at + n + length - gram] == value).sum() > 1
        out.append((at, n, int(value.view(np.int64)), bool(twice)))
    return out


def _compressed(df: DataFrame, text: str) -> DataFrame:
    """df with its last column, a text, as compressed bytes: what a join has to move."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = T.StructType([*df.schema.fields[:-1], T.StructField(text, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for batch in batches:
            packed = [
                len(value).to_bytes(8, "little") + pa.compress(value, "zstd", asbytes=True)
                for value in byte_values(batch.column(batch.num_columns - 1))
            ]
            last = pa.array(packed, schema.field(batch.num_columns - 1).type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], names=schema.names)

    return df.mapInArrow(run, out)


def _texts(column: pa.Array) -> Iterator[bytes]:
    """The texts of a column that _compressed made, one at a time."""
    for value in column:
        packed = value.as_py()
        size = int.from_bytes(packed[:8], "little")
        yield pa.decompress(packed[8:], size, "zstd", asbytes=True) if size else b""


def _segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """key, at, n, a, s, twice, weight: the segments of texts (key, text), a their least hash and s
    the digest of their bytes. Equal texts of a batch are one, their number is the weight."""
    schema = pa.schema(
        [("key", pa.binary()), ("at", pa.int32()), ("n", pa.int32()), ("a", pa.int64()),
         ("s", pa.int64()), ("twice", pa.bool_()), ("weight", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            weight: dict[bytes, int] = {}
            for key in keys:
                weight[key] = weight.get(key, 0) + 1
            rows, digests, left = [], [], dict(weight)
            for key, text in zip(keys, byte_values(batch.column(1))):
                n = left.pop(key, 0)
                if not n:
                    continue
                for at, size, a, twice in text_segments(np.frombuffer(text, np.uint8), length, gram):
                    rows.append((key, at, size, a, twice, n))
                    digests.append(xxhash.xxh3_64_digest(text[at : at + size + length - 1]))
            key, at, size, a, twice, n = zip(*rows) if rows else [()] * 6
            columns = [key, at, size, a, np.frombuffer(b"".join(digests), np.int64), twice, n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
            )

    return texts.mapInArrow(
        run, "key binary, at int, n int, a long, s long, twice boolean, weight long"
    )


# The suffix array of a block.


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not."""
    change = np.flatnonzero(data[1:] != data[:-1])
    rises = np.r_[data[change] < data[change + 1], False]
    return np.repeat(rises, np.diff(np.r_[-1, change, len(data) - 1]))


def _refined(rank: np.ndarray, tied: np.ndarray, second: np.ndarray, limit: int) -> np.ndarray:
    """Split the groups of equal rank (all of their members tied) by a second value below limit,
    in place; the members of the groups that are left. A rank is the number of smaller members."""
    old = rank[tied]
    if int(old.max()) * limit < 2**63 - limit:  # one number for both sorts faster
        order = np.argsort(old * limit + second)
    else:
        order = np.lexsort((second, old))
    tied, second, old = tied[order], second[order], old[order]
    outer = np.r_[True, old[1:] != old[:-1]]
    inner = outer | np.r_[True, second[1:] != second[:-1]]
    places = np.arange(len(tied))
    first = np.maximum.accumulate(np.where(inner, places, 0))
    group = np.maximum.accumulate(np.where(outer, places, 0))
    rank[tied] = old + first - group
    single = inner & np.r_[inner[1:], True]
    return tied[~single]


def sorted_directly(data: np.ndarray, smaller: np.ndarray, length: int) -> np.ndarray:
    """The starts of the suffixes smaller than their successors, in order by `length` bytes.

    Such a suffix is a sequence of stretches, each from one start to the next. Within a stretch
    all others are larger than their successors, which decides between equal bytes: so a stretch
    is read as (byte, smaller) symbols. Stretches get ranks, and pairs of ranks double the reach.
    """
    starts = np.flatnonzero(smaller)
    if not len(starts):
        return starts
    symbols = np.r_[2 * data.astype(np.int64) + smaller + 1, 0]
    # The last stretch goes to the end of the data, which is smaller than any byte.
    sizes = np.r_[starts[1:] + 1, len(data) + 1] - starts
    rank = np.zeros(len(starts), np.int64)
    tied, done = np.arange(len(starts)), 0
    while len(tied) and done < length:
        packed = np.zeros(len(tied), np.int64)
        for i in range(done, done + 6):
            place = np.where(i < sizes[tied], starts[tied] + i, len(data))
            packed = packed << 10 | symbols[place]
        tied = _refined(rank, tied, packed, 1 << 60)
        done += 6
        tied = tied[sizes[tied] > done]
    size, step = np.bincount(rank, minlength=len(rank)), 1
    tied = np.flatnonzero(size[rank] > 1)
    while len(tied) and step < length:
        after = tied + step
        second = np.where(after < len(rank), rank[np.minimum(after, len(rank) - 1)] + 1, 0)
        tied = _refined(rank, tied, second, len(rank) + 1)
        step *= 2
    return starts[np.argsort(rank, kind="stable")]


def suffix_array(data: np.ndarray, length: int) -> np.ndarray:
    """All suffixes in order by their first `length` bytes at least."""
    smaller = smaller_than_next(data)
    size = np.bincount(data, minlength=256)
    direct = np.bincount(data[smaller], minlength=256)
    bucket = np.r_[0, np.cumsum(size)[:-1]]
    second = bucket + size - direct
    array = np.empty(len(data), np.int64)
    chosen = sorted_directly(data, smaller, length)
    array[np.repeat(second - np.r_[0, np.cumsum(direct)[:-1]], direct) + np.arange(len(chosen))] = chosen
    free = bucket.copy()

    def induce(found: np.ndarray) -> None:
        """Put the larger predecessors of these suffixes at the next places of their buckets."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        if not len(before):
            return
        first = data[before]
        order = np.argsort(first, kind="stable")
        first, before = first[order], before[order]
        many = np.bincount(first, minlength=256)
        array[free[first] + np.arange(len(first)) - (np.cumsum(many) - many)[first]] = before
        free[:] += many

    array[free[data[-1]]] = len(data) - 1
    free[data[-1]] += 1
    for byte in np.flatnonzero(size):
        at = bucket[byte]
        while at < free[byte]:  # a suffix may put its predecessor into its own bucket
            found = array[at : free[byte]].copy()
            at = free[byte]
            induce(found)
        induce(array[second[byte] : second[byte] + direct[byte]])
    return array


def shared_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each start but the last has a common prefix of `length` bytes with the next one.
    All starts have that many bytes.

    Neighbours in the array differ late, so their words are compared from the last one on.
    """
    words = np.ndarray((len(data) - 7,), np.uint64, data.tobytes(), strides=(1,))
    left, right = order[:-1], order[1:]
    alive = np.arange(len(left))
    for at in [*range(length - 8, 0, -8), 0]:
        alive = alive[words[left[alive] + at] == words[right[alive] + at]]
    shared = np.zeros(len(left), bool)
    shared[alive] = True
    return shared


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """Of each part, whether its windows occur anywhere else in the parts."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.ones(len(data), bool)
    ends = np.cumsum([len(p) for p in parts])
    for end in ends.tolist():
        starts[end - length + 1 : end] = False
    order = suffix_array(data, length)
    order = order[starts[order]]
    reach = shared_prefixes(data, order, length)
    repeated = np.zeros(len(data), bool)
    repeated[order[:-1][reach]] = True
    repeated[order[1:][reach]] = True
    return [repeated[e - len(p) : e - length + 1] for p, e in zip(parts, ends.tolist())]


def _runs(marked: np.ndarray) -> list[int]:
    """From, to, from, to ... of the stretches that are True."""
    return np.flatnonzero(np.diff(np.r_[False, marked, False])).tolist()


def _blocks(pieces: DataFrame, blocks: int, length: int, block_bytes: int) -> DataFrame:
    """key, at, runs of the repeated windows in pieces (SEGMENT, key, at, whole, bytes)."""
    schema = pa.schema(
        [("key", pa.binary()), ("at", pa.int32()), ("runs", pa.list_(pa.int32()))]
    )

    def run(group: pa.Table) -> pa.Table:
        rows = group.select([*SEGMENT, "key", "at", "whole", "bytes"]).to_pylist()
        rows = {tuple(r[c] for c in SEGMENT): r for r in rows}  # repeated rows are one text
        found: list[dict] = []
        held: list[dict] = []

        def close() -> None:
            for row, marked in zip(held, repeated_windows([r["bytes"] for r in held], length)):
                if not row["whole"] and marked.any():
                    found.append({"key": row["key"], "at": row["at"], "runs": _runs(marked)})
            held.clear()

        size, last = 0, None
        for name in sorted(rows):
            if size > block_bytes and name[0] != last:
                close()
                size = 0
            held.append(rows[name])
            size += len(rows[name]["bytes"])
            last = name[0]
        close()
        return pa.Table.from_pylist(found, schema)

    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(run, "key binary, at int, runs array<int>")


def _windows(pieces: DataFrame, length: int) -> DataFrame:
    """key, at, runs as _blocks gives them, by the digests of all windows."""
    names = [*SEGMENT, "key", "at", "weight", "i", "d1", "d2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                text = row["bytes"]
                n = len(text) - length + 1
                digests = b"".join(xxhash.xxh3_128_digest(text[j : j + length]) for j in range(n))
                pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
                same = [row["a"], row["s"], row["key"], row["at"], 2 if row["whole"] else 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * n, t) for v, t in zip(same, types)]
                    + [pa.array(np.arange(n), pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                    names=names,
                )

    types = [pa.int64()] * 2 + [pa.binary(), pa.int32(), pa.int64()]
    all_windows = pieces.mapInArrow(
        run,
        "a long, s long, key binary, at int, weight long, i int, d1 long, d2 long",
    )
    all_windows = materialize(
        all_windows.dropDuplicates([*SEGMENT, "i"]), "suffix-windows"
    )
    repeated = all_windows.groupBy("d1", "d2").agg(F.sum("weight").alias("times")).where("times > 1")
    marked = all_windows.where("weight = 1").join(repeated, ["d1", "d2"])
    # A segment has LONGEST windows at most.
    marked = marked.groupBy("key", "at").agg(F.collect_list("i").alias("i"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for found in batch.column(2):
                own = np.zeros(LONGEST, bool)
                own[found.values.to_numpy()] = True
                runs.append(_runs(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(runs, pa.list_(pa.int32()))],
                names=["key", "at", "runs"],
            )

    return marked.mapInArrow(joined, "key binary, at int, runs array<int>")


def _pieces(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """SEGMENT, key, at, whole, hot, bytes: the wanted segments, cut out of their texts."""
    names = [*SEGMENT, "key", "at", "whole", "hot", "bytes"]
    types = [pa.int64()] * 2 + [pa.binary(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for key, segments, text in zip(
                batch.column(0).to_pylist(), batch.column(1), _texts(batch.column(2))
            ):
                for s in segments.as_py():
                    part = text[s["at"] : s["at"] + s["n"] + length - 1]
                    rows.append((s["a"], s["s"], key, s["at"], s["whole"], s["hot"], part))
                    size += len(part)
                if size > BLOCK:
                    yield made(rows)
                    rows, size = [], 0
            if rows:
                yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
        )

    # One row of each text: a pair of key and id that is in the table.
    packed = _compressed(docs.select("key", "id", "text"), "text")
    return packed.join(wanted, ["key", "id"]).select("key", "segments", "text").mapInArrow(
        run,
        "a long, s long, key binary, at int, whole boolean, hot boolean, bytes binary",
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK
) -> DataFrame:
    """key, n_texts, spans: for each distinct text of docs (key, id, text) the number of rows with
    it and the bytes (from, to) of repeated windows, where it occurs once."""
    if not 16 <= gram + 8 <= length:
        raise ValueError("length has to be 8 bytes more than a gram, a gram 8 bytes at least")
    long_texts = docs.where(F.octet_length("text") >= length)
    segments = materialize(
        _segments(long_texts.select("key", "text"), length, gram), "suffix-segments"
    )
    texts = materialize(
        docs.groupBy("key").agg(F.count(F.lit(1)).alias("n_texts"), F.min("id").alias("id")),
        "suffix-texts",
    )
    # Most hashes occur once. The others go on, dealt by hash and digest: a hash may be hot.
    counted = segments.groupBy("a").agg(F.sum("weight").alias("times"), F.max("twice").alias("twice"))
    shared = segments.join(counted.where("times > 1 OR twice").select("a"), "a", "left_semi")
    shared = materialize(shared, "suffix-shared")
    kinds = shared.groupBy(*SEGMENT).agg(
        F.sum("weight").alias("times"),
        F.min(F.struct("key", "at")).alias("one"),
        F.max("twice").alias("twice"),
        F.max("n").alias("n"),
    )
    kinds = materialize(kinds, "suffix-kinds")
    groups = kinds.groupBy("a").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.count_if(F.col("times") == 1).alias("singles"),
        F.sum(F.col("n") + length - 1).alias("bytes"),
    )
    # A hash of one kind has nothing to compare, and neither has one all of whose kinds repeat.
    groups = groups.where("singles > 0").select(
        "a", "kinds", (F.col("bytes") > block_bytes).alias("hot"), "bytes"
    )
    compared = kinds.join(groups, "a").where("kinds > 1 OR twice")
    wanted = compared.select(
        F.col("one")["key"].alias("key"),
        F.struct(
            F.col("one")["at"].alias("at"), "n", *SEGMENT, (F.col("times") > 1).alias("whole"), "hot"
        ).alias("segment"),
    )
    # Bounded by the text itself.
    wanted = wanted.groupBy("key").agg(F.collect_list("segment").alias("segments"))
    wanted = wanted.join(texts.select("key", "id"), "key")
    pieces = materialize(_pieces(docs, wanted, length), "suffix-pieces")
    sizes = pieces.agg(
        F.sum(F.when(~F.col("hot"), F.octet_length("bytes"))), F.count_if("hot")
    ).first()
    blocks = max(1, -(-(sizes[0] or 0) // block_bytes))
    marks = _blocks(pieces.where("NOT hot"), blocks, length, block_bytes)
    if sizes[1]:
        marks = marks.union(_windows(pieces.where("hot"), length))
    marked = marks.withColumn("pair", F.explode(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2))))
    span = F.struct(
        (F.col("at") + F.get("runs", F.col("pair"))).alias("from"),
        (F.col("at") + F.get("runs", F.col("pair") + 1) + length - 1).alias("to"),
    )
    spans = marked.select("key", span.alias("span"))
    whole = shared.join(kinds.where("times > 1").select(*SEGMENT), SEGMENT, "left_semi")
    whole = whole.join(texts.where("n_texts = 1"), "key", "left_semi").select(
        "key",
        F.struct(
            F.col("at").alias("from"), (F.col("at") + F.col("n") + length - 1).alias("to")
        ).alias("span"),
    )
    spans = spans.union(whole).groupBy("key").agg(F.collect_list("span").alias("spans"))
    return texts.select("key", "n_texts").join(spans, "key", "left")


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    text: str = "text",
    doc_id: str = "doc_id",
    gram: int = GRAM,
    block_bytes: int = BLOCK,
) -> tuple[DataFrame, dict[str, str]]:
    """docs with kept (the bytes that are left), n_bytes, n_removed and n_spans, and the (unused)
    names of these columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = ("kept", "n_bytes", "n_removed", "n_spans")
    names = dict(zip(wanted, fresh(docs, *wanted)))
    key, value, spans, n = fresh(docs, "text_key", "text_value", "text_spans", "text_rows")
    keyed = docs.withColumn(value, text_or_empty(text))
    keyed = keyed.withColumn(key, F.unhex(F.md5(F.col(value).cast("binary"))))
    plain = keyed.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.col(value).alias("text"),
    )
    found = repeated_spans(plain, length, gram, block_bytes).select(
        F.col("key").alias(key), F.col("n_texts").alias(n), F.col("spans").alias(spans)
    )
    packed = _compressed(keyed.select(*docs.columns, key, value), value)
    joined = packed.join(found, key).select(*docs.columns, value, n, spans)
    out = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(names["kept"], T.BinaryType()),
            *[T.StructField(names[c], T.LongType()) for c in wanted[1:]],
        ]
    )
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for batch in batches:
            kept, counts = [], []
            for data, times, cuts in zip(
                _texts(batch.column(width)),
                batch.column(width + 1).to_pylist(),
                batch.column(width + 2),
            ):
                if times > 1 and len(data) >= length:
                    merged = [[0, len(data)]]
                else:
                    merged = []
                    for cut in sorted((c["from"], c["to"]) for c in cuts.as_py() or ()):
                        if merged and cut[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], cut[1])
                        else:
                            merged.append(list(cut))
                edges = [0, *[e for m in merged for e in m], len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(left)
                counts.append((len(data), len(data) - len(left), len(merged)))
            added = [pa.array(kept, schema.field(names["kept"]).type)]
            added += [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else ([],) * 3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *added], names=schema.names)

    return joined.mapInArrow(run, out), names
