"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. Adaptive execution coalesces the shuffle partitions of
# small results, splits hot join keys and hot write partitions, and turns a sort-merge
# join into a broadcast join once the measured size of a side allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Adaptive execution merges small shuffle partitions but splits no large ones of a sort, so a
# session that names no number of its own starts with many.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def build_session(
    app: str = "riskloom", master: str | None = None, **settings: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    named = {SHUFFLE_PARTITIONS, INITIAL_PARTITIONS} & (
        set(settings) | {key for key, _ in session.sparkContext.getConf().getAll()}
    )
    if not named and not is_local(session):
        session.conf.set(INITIAL_PARTITIONS, "4000")
    return session


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in this process and so see its disk."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-riskloom-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder named by spark.checkpoint.dir.

    Only a local-mode session may leave the setting out: all its tasks see the same disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/riskloom/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write df once to the shared folder and continue from the written table.

    Iterative jobs read it many times; a lost executor costs a re-read, not a re-run
    of the joins and aggregates behind it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_finished(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now.

    Spark removes them when the driver's garbage collection finds their plans unused, which a
    driver with room to spare does late; the executors' disks then hold those of all jobs.
    """
    spark._jvm.System.gc()
