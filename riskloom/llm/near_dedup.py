"""Near-duplicate documents by an inverted join over MinHash coordinates.

1. Each text becomes a set of word shingles and a signature of coordinates to be posted.
2. Texts with the same set form a class; from here on a class is its smallest doc_id.
3. A class is posted under its coordinate-value pairs. A pair of classes has to collide in
   `least` of the coordinates; so, if each leaves out its least - 1 most frequent ones, the
   pair still meets under one of the others (prefix filter), and a class with fewer than
   `least` shared coordinates needs no posting at all. Frequent coordinate-value pairs, as
   a passage in very many documents gives, are thus left out first.
4. Posted classes, a small part of all, get a sketch with a byte for each of many further
   coordinates. The lists are merged in tasks. Lists longer than a block are cut into blocks,
   and each pair of blocks is merged by itself. Collisions are counted on the sketch; pairs
   below the match threshold go no further. A pair is handled under its first common list.
5. First each class is paired with its best partner of a list, by the first part of the
   sketch, and these pairs are verified and joined to components. Then all pairs that are
   still in different components follow, by the whole sketch: merging skips lists and pairs
   that are already joined. So a group of copies costs about one pair per member, and no link
   between components is lost.
6. Pairs are verified on the full shingle sets.

The thresholds are set so that a pair at the similarity limit is missed with a probability
of 1e-6 each; above the limit it falls further.

Defined cases: a text without words (null, empty, white space) has no shingles and links
with nothing. A shorter text than a shingle is one shingle. Rows that share a doc_id are
one node and link what each of them links. Rows without doc_id belong to the component of
their copies, and stay by themselves (component null, kept) if they have no copy with an
id. Extra columns are kept, whatever their names.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WORDS, byte_values, fresh, mixed, signed, windows
from riskloom.llm.components import components
from riskloom.session import materialize

SHINGLE = 5
PERCENT = 80
POSTED = 32
SKETCH = 1024
FIRST_PART = 256
MISS = 1e-6
BLOCK = 512
SEED = 7
STEP = 1 << 16


def least_matches(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The largest threshold that a pair at the limit misses with that probability at most."""
    p, total = percent / 100, 0.0
    for least in range(coordinates + 1):
        total += comb(coordinates, least) * p**least * (1 - p) ** (coordinates - least)
        if total > miss:
            return max(1, least)
    return coordinates


def _factors(count: int, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    return random.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of the shingles; A-Z are lower-cased."""
    return np.unique(windows(WORDS.of((text or b"").lower().split()), size))


def _least(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Per factor the smallest product with a shingle hash."""
    least = np.full(len(factors), 2**64 - 1, np.uint64)
    step = max(1, STEP // len(factors))
    for start in range(0, len(own), step):
        products = factors[:, None] * own[None, start : start + step]
        np.minimum(least, products.min(axis=1), out=least)
    return least


def posted_values(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A long per coordinate, different for equal values of different coordinates."""
    return signed(mixed(_least(own, factors) ^ mixed(factors)))


def sketch_bytes(own: np.ndarray, factors: np.ndarray) -> bytes:
    return (_least(own, factors) >> np.uint64(40)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, hi, lo (of the set), tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(POSTED, SEED)
        known: OrderedDict[bytes, np.ndarray] = OrderedDict()
        nothing = np.empty(0, np.int64)
        for batch in batches:
            counts, keys, tokens = [], [], []
            for text in byte_values(batch.column(1)):
                own = shingles(text, size)
                key = xxhash.xxh3_128_digest(own.tobytes())
                counts.append(len(own))
                keys.append(key)
                if len(own) and key not in known:
                    known[key] = posted_values(own, factors)
                    if len(known) > 1000:
                        known.popitem(last=False)
                tokens.append(known[key] if len(own) else nothing)
            ends = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
            pairs = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                    pa.ListArray.from_arrays(ends, np.concatenate([nothing, *tokens])),
                ],
                names=["doc_id", "n_shingles", "hi", "lo", "tokens"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, hi long, lo long, tokens array<long>"
    )


def prefixes(reps: DataFrame, least: int) -> DataFrame:
    """id and its prefix: the tokens it is posted under, a sorted array."""
    posts = reps.select("id", F.explode("tokens").alias("token"))
    shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # At most POSTED entries for each id.
    own = posts.join(shared, "token").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("n", "token"))).alias("own")
    )
    kept = F.slice("own", F.lit(1), F.size("own") - F.lit(least - 1))
    return own.where(F.size("own") >= least).select(
        "id", F.array_sort(F.transform(kept, lambda x: x["token"])).alias("prefix")
    )


def posted_lists(prefix: DataFrame, block: int) -> DataFrame:
    """A row per list, pair of its blocks, and member: token, i, j, own, id."""
    rows = prefix.select("id", F.explode("prefix").alias("token"))
    lengths = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    return (
        rows.join(lengths, "token")
        .withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "token",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "own",
            "id",
        )
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of equal keys, which stand together; held one group at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        marks = np.stack([rows[k].to_numpy() for k in keys])
        starts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1)]
        for start, end in zip(starts, [*starts[1:], rows.num_rows]):
            key = tuple(marks[:, start])
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(start, end - start))
            last = key
    if held:
        yield pa.concat_tables(held)


def _best(matches: np.ndarray, least: int) -> list[int]:
    best = int(matches.argmax())
    return [best] if matches[best] >= least else []


def merged(
    lists: DataFrame, members: DataFrame, percent: int, least: int, across: bool
) -> DataFrame:
    """a, b: the best partner of each member, or all pairs across components."""
    extra = ["component"] if across else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set[tuple[int, int]] = set()
        for group in _groups(batches, ["token", "i", "j"]):
            if group.num_rows > 1:
                pairs.update(_pairs(group, percent, least, across))
            if len(pairs) > 20_000:
                yield _pair_batch(pairs)
                pairs = set()
        if pairs:
            yield _pair_batch(pairs)

    what = members.select("id", "size", "sketch", "prefix", *extra)
    dealt = (
        lists.join(what, "id")
        .select("token", "i", "j", "own", *what.columns)
        .repartition(F.col("token"), F.col("i"), F.col("j"))
        .sortWithinPartitions("token", "i", "j", "id")
    )
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _pair_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*sorted(pairs))
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
    )


def _pairs(group: pa.Table, percent: int, least: int, across: bool) -> Iterator[tuple[int, int]]:
    ids, sizes, own = (group[c].to_numpy() for c in ("id", "size", "own"))
    two_blocks = group["i"][0].as_py() != group["j"][0].as_py()
    joined = group["component"].to_numpy() if across else None
    if across and (joined == joined[0]).all():
        return
    sketches = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8)
    sketches = sketches.reshape(len(ids), -1)
    prefix = group["prefix"].to_pylist() if across else None
    token = group["token"][0].as_py()
    for k in range(len(ids)):
        fits = np.minimum(sizes, sizes[k]) * 100 >= np.maximum(sizes, sizes[k]) * percent
        fits[k] = False
        if two_blocks:
            fits &= own != own[k]
        if across:
            fits[:k] = False
            fits &= joined != joined[k]
        rows = np.flatnonzero(fits)
        if not len(rows):
            continue
        matches = (sketches[rows] == sketches[k]).sum(axis=1)
        for m in np.flatnonzero(matches >= least) if across else _best(matches, least):
            other = rows[m]
            if across and min(set(prefix[k]).intersection(prefix[other])) != token:
                continue
            yield min(ids[k], ids[other]), max(ids[k], ids[other])


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(doc_id: int, text: bytes) -> np.ndarray:
            if doc_id not in sets:
                sets[doc_id] = shingles(text, size)
                if len(sets) > 64:
                    sets.popitem(last=False)
            return sets[doc_id]

        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (0, 1))
            linked = []
            for i, x, y in zip(
                range(len(a)), byte_values(batch.column(2)), byte_values(batch.column(3))
            ):
                one, two = of(a[i], x), of(b[i], y)
                both = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    first, second = (
        texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"
    )
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def linked(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, hi, lo, n_shingles and component_id, a row per document row."""
    rows = materialize(signatures(docs, shingle), "near-signatures")
    # Copies are reduced to one row per class and task before they are shuffled.
    smallest = F.min(F.struct("doc_id", "n_shingles", "tokens")).alias("x")
    full = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = materialize(full.groupBy("hi", "lo").agg(smallest).select("hi", "lo", "x.*"), "near-classes")
    # An id that stands for several classes (rows with one id, different texts) is posted
    # and verified for each of them, under a number of its own.
    nodes = reps.withColumnRenamed("doc_id", "doc").withColumn("id", F.xxhash64("hi", "lo"))
    prefix = materialize(prefixes(nodes, least_matches(POSTED, percent)), "near-prefixes")
    lists = materialize(posted_lists(prefix, block), "near-lists")
    texts = materialize(posted_texts(docs, prefix, nodes, shingle), "near-texts")
    members = texts.select("id", "size", "sketch").join(prefix, "id")

    part = members.withColumn("sketch", F.substring("sketch", 1, FIRST_PART))
    least = least_matches(FIRST_PART, percent)
    pairs = merged(lists, part, percent, least, across=False)
    near = materialize(verified(pairs, texts, shingle, percent), "near-links")
    joined = components(near)
    known = joined.withColumnRenamed("component", "known")
    known = prefix.select("id").join(known, "id", "left")
    known = known.select("id", F.coalesce("known", "id").alias("component"))
    # Lists whose members are all in one component have nothing left to join.
    mixed_lists = lists.join(known, "id").groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed_lists = mixed_lists.where("low <> high").select("token")
    rest = materialize(lists.join(mixed_lists, "token", "left_semi"), "near-lists")
    members = members.join(known, "id")
    least = least_matches(SKETCH, percent)
    pairs = merged(rest, members, percent, least, across=True)
    more = verified(pairs, texts, shingle, percent)

    # Rows with one id and different texts tie the classes of these texts.
    node = F.xxhash64("hi", "lo")
    several = full.groupBy("doc_id").agg(F.min(node).alias("b"), F.max(node).alias("high"))
    several = several.where("b <> high").select("doc_id", "b")
    tied = full.select("doc_id", node.alias("a")).join(several, "doc_id").select("a", "b")
    stars = joined.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = components(stars.union(more).union(tied))
    # The smallest document of a component stands for it.
    grouped = nodes.select("id", "doc").join(found, "id")
    lowest = grouped.groupBy("component").agg(F.min("doc").alias("low"))
    of_node = grouped.join(lowest, "component").select("id", "low")
    classes = nodes.select("id", "hi", "lo", "doc").join(of_node, "id", "left")
    classes = classes.select("hi", "lo", F.coalesce("low", "doc").alias("component_id"))
    member = rows.select("doc_id", "n_shingles", "hi", "lo").join(classes, ["hi", "lo"], "left")
    return member.withColumn("component_id", F.coalesce("component_id", "doc_id")).select(
        "doc_id", "hi", "lo", "n_shingles", "component_id"
    )


def posted_texts(
    docs: DataFrame, prefix: DataFrame, nodes: DataFrame, shingle: int
) -> DataFrame:
    """id, text, size and sketch of the classes that are posted; any row of a class will do."""
    wanted = prefix.select("id").join(nodes.select("id", "doc", "hi", "lo"), "id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(wanted, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(SKETCH, SEED + 1)
        for batch in batches:
            sets = [shingles(t, shingle) for t in byte_values(batch.column(1))]
            keys = b"".join(xxhash.xxh3_128_digest(own.tobytes()) for own in sets)
            pairs = np.frombuffer(keys, np.int64).reshape(-1, 2)
            # Another row with the same id may have another text.
            same = (pairs[:, 0] == batch.column(2).to_numpy()) & (
                pairs[:, 1] == batch.column(3).to_numpy()
            )
            kept = batch.filter(pa.array(same))
            sets = [own for own, ok in zip(sets, same) if ok]
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column(0),
                    kept.column(1),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([sketch_bytes(own, factors) for own in sets], pa.binary()),
                ],
                names=["id", "text", "size", "sketch"],
            )

    own = rows.select("id", "text", "hi", "lo").mapInArrow(
        run, "id long, text string, size long, sketch binary"
    )
    return own.dropDuplicates(["id"])


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per document."""
    found = linked(docs, shingle, percent)
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", same.alias("kept"))


def without_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """docs with one document (doc_id) of each component. Rows without doc_id cannot be named
    and stay."""
    found = near_duplicates(docs, shingle, percent).where("NOT kept AND doc_id IS NOT NULL")
    (gone,) = fresh(docs, "gone_id")
    ids = found.select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col(gone), "left_anti")
