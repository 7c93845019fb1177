"""Checkpointed writes whose effect a replay does not repeat.

A micro-batch is known by its stream and its number. The stream's id is the one that its
checkpoint holds, so a restart from the checkpoint is the same stream and a new checkpoint
is another one, whose batches start at 0 again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.sinks.jdbc import append_batch_jdbc
from riskloom.sinks.versions import (
    commit_version,
    latest_version,
    numbered,
    remove,
    remove_versions_before,
    size_of,
)
from riskloom.sources.jdbc import JdbcTable

# Gets a micro-batch, its number and the id of its stream; says whether it wrote anything.
BatchWriter = Callable[[DataFrame, int, str], bool]

# For a state that grows with the reports. RocksDB keeps it on the executors' disks, where the
# default holds every row as objects in the heap; a micro-batch writes its changes only. In memory
# a partition of the state has two write buffers and a cache of 8 MB each, besides the index of its
# files. Counting the rows would cost a read for each new one, so numRowsTotal stays 0. Zstandard
# takes less disk than the default, both for the store and for the changes.
STATE_STORE = "spark.sql.streaming.stateStore"
LARGE_STATE = {
    f"{STATE_STORE}.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE_STORE}.rocksdb.writeBufferSizeMB": "8",
    f"{STATE_STORE}.rocksdb.maxWriteBufferNumber": "2",
    f"{STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{STATE_STORE}.rocksdb.compression": "zstd",
    f"{STATE_STORE}.compression.codec": "zstd",
}

OWNER = "_stream"
BATCH = "batch_id"
COMPACTED = "_compacted"
SEGMENT = "segment"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives to its stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_batches(
    stream: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    output_mode: str = "append",
    large_state: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to write_batch; with available_now stop after what is there.

    With large_state the stream starts with LARGE_STATE, as far as the session does not set it
    otherwise. A checkpoint keeps the kind of state store that it began with.
    """
    known: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(stream_id(batch.sparkSession, checkpoint))
        write_batch(batch, batch_id, known[0])

    writer = stream.writeStream.foreachBatch(handle).outputMode(output_mode)
    with _defaults(stream.sparkSession, LARGE_STATE if large_state else {}):
        return _start(writer.option("checkpointLocation", checkpoint), available_now, interval)


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str | None = None,
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Append to Parquet files, in folders by keys, through Spark's own exactly-once file sink."""
    writer = stream.writeStream.format("parquet").option("path", path)
    if keys:
        writer = writer.partitionBy(*keys)
    return _start(writer.option("checkpointLocation", checkpoint), available_now, interval)


@contextmanager
def _defaults(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that the session does not name, while a stream starts: it keeps a copy of them."""
    added = [key for key in settings if spark.conf.get(key, None) is None]
    for key in added:
        spark.conf.set(key, settings[key])
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def _start(writer, available_now: bool, interval: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def _owner(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.text(f"{path}/{OWNER}").first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def claim(spark: SparkSession, path: str, stream: str) -> None:
    """Bind a folder to one stream; raise if it belongs to another."""
    owner = _owner(spark, path)
    if owner is None:
        mark = spark.createDataFrame([(stream,)], "value STRING").coalesce(1)
        mark.write.mode("overwrite").text(f"{path}/{OWNER}")
    elif owner != stream:
        raise ValueError(
            f"{path} holds the batches of stream {owner}; stream {stream} needs a folder of its own"
        )


def parquet_batches(path: str) -> BatchWriter:
    """Each micro-batch becomes one folder, overwritten if the batch comes again.

    The folder belongs to the stream that wrote to it first; another one is refused, since
    its batches have the same numbers.
    """
    claimed: set[str] = set()

    def write(batch: DataFrame, batch_id: int, stream: str) -> bool:
        if stream not in claimed:
            claim(batch.sparkSession, path, stream)
            claimed.add(stream)
        if batch_id <= _compacted(batch.sparkSession, path)["upto"]:
            return False
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        return True

    return write


def _compacted(spark: SparkSession, path: str) -> dict:
    found = latest_version(spark, f"{path}/{COMPACTED}")
    return found[1] if found else {"upto": -1, "segments": []}


def _segments(path: str, numbers: list[int]) -> list[str]:
    return [f"{path}/{COMPACTED}/{SEGMENT}={n}" for n in numbers]


def _batches(path: str, numbers: list[int]) -> list[str]:
    return [f"{path}/{BATCH}={n}" for n in numbers]


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that were written whole, compacted or not."""
    done = _compacted(spark, path)
    later = [n for n in numbered(spark, path, BATCH) if n > done["upto"]]
    folders = _segments(path, done["segments"]) + _batches(path, later)
    return spark.read.parquet(*(folders or [path]))


def compact_batches(spark: SparkSession, path: str, segment_bytes: int = 1 << 30) -> bool:
    """Rewrite the folders of finished batches as one segment; say whether there were any.

    The newest batch is left out, since only that one can come again. Segments below
    segment_bytes are written anew together with the batches, so there are at most about
    size / segment_bytes of them and a row is rewritten only until its segment is large enough.
    Files have the advisory partition size. The segment counts once the version that names it is
    committed; folders of the version before stay until the next compaction, so a reader that has
    opened them can finish. One compaction runs at a time, beside the stream and its readers.
    """
    base = f"{path}/{COMPACTED}"
    number, last = latest_version(spark, base) or (-1, {"upto": -1, "segments": []})
    fresh = [n for n in numbered(spark, path, BATCH)[:-1] if n > last["upto"]]
    if not fresh:
        return False
    number += 1
    sizes = {n: size_of(spark, f) for n, f in zip(last["segments"], _segments(path, last["segments"]))}
    small = [n for n in last["segments"] if sizes[n] < segment_bytes]
    rows = spark.read.parquet(*_segments(path, small), *_batches(path, fresh))
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{base}/{SEGMENT}={number}")
    segments = [n for n in last["segments"] if n not in small] + [number]
    commit_version(spark, base, number, {"upto": fresh[-1], "segments": segments})
    remove_versions_before(spark, base, number - 1)
    for old in numbered(spark, path, BATCH):
        if old <= last["upto"]:
            remove(spark, f"{path}/{BATCH}={old}")
    for old in numbered(spark, base, SEGMENT, whole=False):
        if old < number and old not in {*segments, *last["segments"]}:
            remove(spark, f"{base}/{SEGMENT}={old}")
    return True


def jdbc_batches(target: JdbcTable, **options: str) -> BatchWriter:
    """Each micro-batch is appended to a table once, however often it comes."""

    def write(batch: DataFrame, batch_id: int, stream: str) -> bool:
        return append_batch_jdbc(batch, target, batch_id, stream, **options)

    return write


def latest_result(path: str, keep: int = 3) -> BatchWriter:
    """Keep the whole result of a query in complete mode, a new folder for each micro-batch.

    read_latest takes the last complete one, so a reader never meets a result being replaced.
    The last results stay for readers that have opened them, older ones are removed.
    """
    if keep < 1:
        raise ValueError("keep at least the current result")
    write_folder = parquet_batches(path)

    def write(batch: DataFrame, batch_id: int, stream: str) -> bool:
        wrote = write_folder(batch, batch_id, stream)
        for old in numbered(batch.sparkSession, path, BATCH)[:-keep]:
            remove(batch.sparkSession, f"{path}/{BATCH}={old}")
        return wrote

    return write


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The result of the last micro-batch that was written whole."""
    whole = numbered(spark, path, BATCH)
    return spark.read.parquet(f"{path}/{BATCH}={whole[-1]}" if whole else path)
