"""Reversible line dedup: sharded cuckoo filters before exact reference counts.

A line's key is the line without white space at both ends, A-Z lower-cased. Each document
refers to a key once, however often the line occurs in it. The index holds

* references: key and document, its doc_id and a hash of its text, appended without a shuffle,
* counts:     per key the number of documents and the largest doc_id (exact),
* filters:    per shard cuckoo filters with the keys that are repeated often enough.

Inserting documents raises counts and puts keys that reach the threshold into the filter
of their shard; deleting documents lowers them again and takes such keys out. Both count
only the references that come or go; of the others only those of keys whose largest doc_id
is deleted are read again, for their next largest. Lines are first tested against the filters; only what passes is joined with the exact counts, so a
false positive of a filter never drops a line.

Defined cases: a null or empty text is one empty line. A row is a document; rows that share
a doc_id count as several documents and get the same lines dropped. A null doc_id is less
than every other; where all documents of a line have none, the line stays. The largest
doc_id keeps every copy of the line in its text. Rows that share a doc_id, or have none, are
told apart by their texts, so the lines to drop from one row are never those of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import WHITE, byte_values, fresh
from riskloom.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
SHARDS = 32
SPREAD = 16
ROWS_PER_GROUP = 200_000

SLOTS = 4
KICKS = 400
LOAD = 0.85


# Cuckoo filter: buckets of four 16-bit fingerprints, 0 where empty. A list of filters grows by
# one of twice the size when the last is full. With several it is not certain which one holds a
# key, so a shard that comes to several is built again, as a single one, from the exact counts.


def _fingerprints(hi: np.ndarray) -> np.ndarray:
    return ((hi.view(np.uint64) >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)


def _others(buckets: np.ndarray, prints: np.ndarray, size: int) -> np.ndarray:
    step = prints.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995)
    return buckets ^ ((step >> np.uint64(20)) & np.uint64(size - 1))


def _places(hi: np.ndarray, lo: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    prints = _fingerprints(hi)
    first = lo.view(np.uint64) & np.uint64(size - 1)
    return prints, first, _others(first, prints, size)


class CuckooFilters:
    """The filters of a shard."""

    def __init__(self, blobs: list[bytes] = ()) -> None:
        self.tables = [np.frombuffer(b, np.uint16).reshape(-1, SLOTS).copy() for b in blobs]

    def blobs(self) -> list[bytes]:
        return [t.tobytes() for t in self.tables]

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray) -> CuckooFilters:
        """Filters of distinct keys: a single one, unless equal fingerprints fill its buckets."""
        count = len(hi)
        while True:
            built = cls()
            built._grow(max(count, 1))
            built.insert(hi, lo)
            if len(built.tables) == 1 or count > 8 * len(hi):
                return built
            count = 2 * max(count, 16)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hi), bool)
        for table in self.tables:
            prints, first, second = _places(hi, lo, len(table))
            found |= (table[first] == prints[:, None]).any(axis=1)
            found |= (table[second] == prints[:, None]).any(axis=1)
        return found

    def _grow(self, count: int) -> None:
        least = max(count / (SLOTS * LOAD), 2 * len(self.tables[-1]) if self.tables else 16)
        self.tables.append(np.zeros((1 << int(np.ceil(np.log2(least))), SLOTS), np.uint16))

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Keys that are not in the shard yet: into free slots at once, the rest by kicks."""
        if not self.tables and len(hi):
            self._grow(len(hi))
        while len(hi):
            left = self._place(hi, lo)
            stuck = next((n for n, i in enumerate(left) if not self._put(hi[i : i + 1], lo[i : i + 1])), None)
            if stuck is None:
                return
            hi, lo = hi[left[stuck:]], lo[left[stuck:]]
            self._grow(len(hi))  # full: the rest goes to the next

    def _place(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Puts keys into free slots of their buckets; positions of those that found none."""
        table = self.tables[-1]
        room = len(hi)
        if table.size <= 1 << 12:
            room = max(0, int(np.ceil(LOAD * table.size)) - np.count_nonzero(table))
        left, later = np.arange(len(hi))[:room], np.arange(len(hi))[room:]
        prints, *places = _places(hi, lo, len(table))
        for bucket in places:
            order = left[np.argsort(bucket[left], kind="stable")]
            at = bucket[order].astype(np.int64)
            rank = np.arange(len(at)) - np.searchsorted(at, at)  # among the keys of a bucket
            free = table[at] == 0
            slot = free & (free.cumsum(axis=1) == rank[:, None] + 1)
            fits = slot.any(axis=1)
            table[at[fits], slot[fits].argmax(axis=1)] = prints[order[fits]]
            left = np.sort(order[~fits])
        return np.concatenate([left, later])

    def _put(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        table = self.tables[-1]
        if table.size <= 1 << 12 and np.count_nonzero(table) >= LOAD * table.size:
            return False
        prints, first, second = _places(hi, lo, len(table))
        print_, path = prints[0], []
        for bucket in (int(first[0]), int(second[0])):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = print_
                return True
        bucket = int(first[0])
        for kick in range(KICKS):
            slot = (int(print_) + kick) % SLOTS
            path.append((bucket, slot, table[bucket, slot]))
            print_, table[bucket, slot] = table[bucket, slot], print_
            bucket = int(
                _others(np.array([bucket], np.uint64), np.array([print_]), len(table))[0]
            )
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = print_
                return True
        for bucket, slot, before in reversed(path):  # full: nothing has changed
            table[bucket, slot] = before
        return False

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Keys that are in the shard. One whose fingerprint more than one filter holds stays:
        the other slot belongs to another key, and which is which is not known."""
        for i in range(len(hi)):
            found = []
            for table in self.tables:
                prints, first, second = _places(hi[i : i + 1], lo[i : i + 1], len(table))
                for b in (int(first[0]), int(second[0])):
                    slots = np.flatnonzero(table[b] == prints[0])
                    if len(slots):
                        found.append((table, (b, int(slots[0]))))
                        break
            if len(found) == 1:
                table, at = found[0]
                table[at] = 0


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def _key(line: bytes, least: int) -> bytes | None:
    key = line.strip(WHITE).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return xxhash.xxh3_128_digest(key)


REFERENCES = ["hi", "lo", "doc_id", "text_hash"]


def _text_hash():
    """Tells rows of one doc_id apart. Lines follow from doc_id and key, so equal hashes do no harm."""
    return F.xxhash64("text").alias("text_hash")


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """hi, lo, doc_id, text_hash: a row per document and key of at least min_chars code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner = [], []
            for row, text in enumerate(byte_values(batch.column(1))):
                own = {_key(line, min_chars) for line in _split(text)} - {None}
                keys += sorted(own)
                owner += [row] * len(own)
            pairs = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                    batch.column(0).take(rows),
                    batch.column(2).take(rows),
                ],
                names=REFERENCES,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash()).mapInArrow(
        run, ", ".join(f"{name} long" for name in REFERENCES)
    )


def _shard(n_shards: int):
    return F.pmod(F.col("hi"), F.lit(n_shards)).cast("int")


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("hi", "lo").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc")
    )


FILTERS = "shard int, filters array<binary>"


def _filter_row(shard: int, blobs: list[bytes] | None) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array([shard], pa.int32()),
            "filters": pa.array([blobs], pa.list_(pa.binary())),
        }
    )


def _key_arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    hi, lo = rows["hi"].to_numpy(), rows["lo"].to_numpy()
    order = np.lexsort((lo, hi))
    return hi[order], lo[order]


def _built_filters(keys: DataFrame) -> DataFrame:
    """A filter per shard of the keys (shard, hi, lo)."""

    def run(rows: pa.Table) -> pa.Table:
        return _filter_row(rows["shard"][0].as_py(), CuckooFilters.of(*_key_arrays(rows)).blobs())

    return keys.groupBy("shard").applyInArrow(run, FILTERS)


def _changed_filters(
    filters: DataFrame, keys: DataFrame, often: DataFrame, n_shards: int
) -> DataFrame:
    """Filters per shard after keys (hi, lo, gone) were put in or taken out; often: all keys
    that are in afterwards. Shards without such keys are passed on as they are; one that has
    or comes to several filters is built again."""

    def run(old: pa.Table, new: pa.Table) -> pa.Table:
        number = (old if old.num_rows else new)["shard"][0].as_py()
        shard = CuckooFilters(old["filters"][0].as_py() if old.num_rows else [])
        if len(shard.tables) < 2:
            gone = new["gone"]
            shard.delete(*_key_arrays(new.filter(gone)))
            shard.insert(*_key_arrays(new.filter(pc.invert(gone))))
        return _filter_row(number, shard.blobs() if len(shard.tables) < 2 else None)

    number = _shard(n_shards).alias("shard")
    keys = keys.select(number, "hi", "lo", "gone")
    touched = keys.select("shard").distinct()
    changed = materialize(
        filters.join(touched, "shard", "left_semi")
        .groupBy("shard")
        .cogroup(keys.groupBy("shard"))
        .applyInArrow(run, FILTERS),
        "line-filters",
    )
    outgrown = changed.where("filters IS NULL").select("shard")
    again = _built_filters(often.select(number, "hi", "lo").join(outgrown, "shard", "left_semi"))
    same = filters.join(touched, "shard", "left_anti")
    return same.unionByName(changed.where("filters IS NOT NULL")).unionByName(again)


@dataclass(frozen=True)
class LineIndex:
    """The state after some insertions and deletions; every table is a written one."""

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    n_shards: int
    min_chars: int
    min_docs: int


def build(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int = SHARDS
) -> LineIndex:
    """An index of these documents. Shards grow with the number of repeated keys."""
    refs = materialize(references(docs, min_chars), "line-references")
    counts = materialize(_counted(refs), "line-counts")
    often = counts.where(F.col("n_docs") >= min_docs)
    n_shards = max(shards, often.count() // ROWS_PER_GROUP)
    keys = often.select(_shard(n_shards).alias("shard"), "hi", "lo")
    filters = materialize(_built_filters(keys), "line-filters")
    return LineIndex(refs, counts, filters, n_shards, min_chars, min_docs)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with further documents."""
    refs = materialize(references(docs, index.min_chars), "line-references")
    before = index.counts.select("hi", "lo", F.col("n_docs").alias("n0"), F.col("max_doc").alias("m0"))
    joined = before.join(_counted(refs), ["hi", "lo"], "full").select(
        "hi",
        "lo",
        (F.coalesce("n0", F.lit(0)) + F.coalesce("n_docs", F.lit(0))).alias("n_docs"),
        F.greatest("m0", "max_doc").alias("max_doc"),
        F.coalesce("n0", F.lit(0)).alias("n0"),
    )
    return _replaced(index, index.references.unionByName(refs), joined)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents whose doc_id is listed; unknown ids are ignored."""
    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    refs = index.references
    gone = materialize(
        _counted(refs.join(ids, "doc_id", "left_semi").select(*REFERENCES)), "line-gone"
    )
    kept = refs.join(ids, "doc_id", "left_anti").select(*REFERENCES)
    kept = materialize(kept, "line-references")
    before = index.counts.select("hi", "lo", F.col("n_docs").alias("n0"), F.col("max_doc").alias("m0"))
    less = before.join(
        gone.select("hi", "lo", F.col("n_docs").alias("n_gone"), F.col("max_doc").alias("m_gone")),
        ["hi", "lo"],
        "left",
    ).select(
        "hi",
        "lo",
        (F.col("n0") - F.coalesce("n_gone", F.lit(0))).alias("n_docs"),
        "m0",
        "n0",
        F.coalesce(F.col("m_gone") == F.col("m0"), F.lit(False)).alias("orphan"),
    )
    less = materialize(less, "line-lowered")
    # Only keys whose largest doc_id went, and that are left, look for the next largest.
    orphans = less.where(F.col("orphan") & (F.col("n_docs") > 0)).select("hi", "lo")
    heirs = kept.join(orphans, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(
        F.max("doc_id").alias("heir")
    )
    largest = F.when(F.col("orphan"), F.col("heir")).otherwise(F.col("m0")).alias("max_doc")
    joined = less.join(heirs, ["hi", "lo"], "left").select("hi", "lo", "n_docs", largest, "n0")
    return _replaced(index, kept, joined)


def _replaced(index: LineIndex, refs: DataFrame, joined: DataFrame) -> LineIndex:
    joined = materialize(joined, "line-counts")
    least = index.min_docs
    often = F.col("n_docs") >= least
    changes = joined.where((F.col("n0") >= least) != often).select("hi", "lo", (~often).alias("gone"))
    filters = _changed_filters(index.filters, changes, joined.where(often), index.n_shards)
    filters = materialize(filters, "line-filters")
    counts = joined.where(F.col("n_docs") > 0).drop("n0")
    return LineIndex(refs, counts, filters, index.n_shards, index.min_chars, least)


def dropped_keys(index: LineIndex, refs: DataFrame) -> DataFrame:
    """doc_id, text_hash, hi, lo of the lines to drop: filters first, exact counts for what passes."""
    often = index.counts.where(F.col("n_docs") >= index.min_docs)
    most, total = index.counts.agg(F.max("n_docs"), F.sum("n_docs")).first()
    most, mean = most or 0, (total or 0) // index.n_shards
    spread = max(SPREAD, -(-max(most, mean) // ROWS_PER_GROUP))
    # A hot line is dealt to several groups; each gets the filters of its shard.
    lines = refs.select(
        *REFERENCES,
        _shard(index.n_shards).alias("shard"),
        F.pmod(F.xxhash64("doc_id", "text_hash", "hi"), F.lit(spread)).cast("int").alias("part"),
    )
    filters = index.filters.withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    )

    def probe(rows: pa.Table, shard: pa.Table) -> pa.Table:
        out = rows.select(REFERENCES)
        if not shard.num_rows or not rows.num_rows:
            return out.slice(0, 0)
        found = CuckooFilters(shard["filters"][0].as_py()).contains(
            out["hi"].to_numpy(), out["lo"].to_numpy()
        )
        return out.filter(pa.array(found))

    maybe = (
        lines.groupBy("shard", "part")
        .cogroup(filters.groupBy("shard", "part"))
        .applyInArrow(probe, ", ".join(f"{name} long" for name in REFERENCES))
    )
    exact = maybe.join(often.select("hi", "lo", "max_doc"), ["hi", "lo"])
    lower = F.col("doc_id").isNull() & F.col("max_doc").isNotNull()
    return exact.where((F.col("doc_id") < F.col("max_doc")) | lower).select(
        "doc_id", "text_hash", "hi", "lo"
    )


def without_lines(docs: DataFrame, drops: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the text that stays, and n_lines and n_dropped (under unused names).

    A null text stays null.
    """
    lines, dropped, keys, owner, of_text = fresh(
        docs, "n_lines", "n_dropped", "drop_keys", "drop_owner", "drop_text"
    )
    # A list holds the distinct lines of one text, however many rows share its doc_id.
    lists = drops.groupBy(F.col("doc_id").alias(owner), F.col("text_hash").alias(of_text)).agg(
        F.collect_set(F.struct("hi", "lo")).alias(keys)
    )
    same_row = F.col("doc_id").cast("long").eqNullSafe(F.col(owner)) & (
        F.xxhash64("text") == F.col(of_text)
    )
    joined = docs.join(lists, same_row, "left").drop(owner, of_text)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(lines, T.LongType()), T.StructField(dropped, T.LongType())]
    )
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            gone = batch.column(batch.num_columns - 1)
            for row, text in enumerate(byte_values(batch.column(at))):
                own = _split(text)
                n_lines.append(len(own))
                if gone[row].is_valid:
                    pairs = [(p["hi"], p["lo"]) for p in gone[row].as_py()]
                    out = {np.array(p, np.int64).tobytes() for p in pairs}
                    own = [line for line in own if _key(line, min_chars) not in out]
                    text = b"\n".join(own)
                n_dropped.append(n_lines[-1] - len(own))
                texts.append(text)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=schema.names,
            )

    return joined.mapInArrow(run, schema)


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int = SHARDS
) -> DataFrame:
    """All documents indexed, then each without the lines that a larger doc_id keeps."""
    index = build(docs, min_chars, min_docs, shards)
    return without_lines(docs, dropped_keys(index, index.references), min_chars)
