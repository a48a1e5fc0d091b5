"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_PARTITION_BYTES = 128 << 20  # what one task sorts without spilling on a usual executor


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Number of shuffle partitions for the largest expected exchange; adaptive execution merges small ones."""
    return max(200, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(app: str = "tidemark", master: str | None = None, shuffled_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, adaptive execution and the UI off.

    Give the size of the largest exchange (about the compressed size of the columns a job reads from its
    largest table) to size shuffles for it.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes))} if shuffled_bytes else {}),
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps of every layer are read and compared in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


SCAN, CLEANUP = "spark.sql.files.maxPartitionBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CODEC, CODEC_DEFAULT, CODEC_DENSE = "spark.sql.parquet.compression.codec", "snappy", "zstd"  # snappy leaves hashes and ids in hexadecimal digits as they are
STAMPS, STAMPS_DEFAULT, STAMPS_PLAIN = "spark.sql.parquet.outputTimestampType", "INT96", "TIMESTAMP_MICROS"  # whole numbers take less time and room, and a scan skips by them
SCAN_DEFAULT, SCAN_BYTES = "134217728b", "16777216b"  # a row with texts is up to 30 times as large in memory, and a task sorts its rows before it deals them


def spare_disk(spark: SparkSession) -> SparkSession:
    """Scans in parts whose rows a task sorts in memory, dense files and timestamps in them as whole numbers, unless the session sets a size, codec or type,
    and shuffle files that go with the query that wrote them."""
    if spark.conf.get(SCAN) == SCAN_DEFAULT:
        spark.conf.set(SCAN, SCAN_BYTES)
    if spark.conf.get(CODEC) == CODEC_DEFAULT:
        spark.conf.set(CODEC, CODEC_DENSE)
    if spark.conf.get(STAMPS) == STAMPS_DEFAULT:
        spark.conf.set(STAMPS, STAMPS_PLAIN)
    spark.conf.set(CLEANUP, "true")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session in one process, as in tests, may set a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the scratch root, never used twice."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    Lineage ends there, so a lost executor never recomputes what came before, and later reads
    prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    if _collecting:
        _collecting[-1].append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _staged_at[out] = path
    return out


_staged_at: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(df: DataFrame | None) -> None:
    """Deletes a copy made by :func:`stage` before :func:`settled` would, once nothing reads it any more."""
    from tidemark.sinks import files
    if df is not None and (path := _staged_at.pop(df, None)):
        files.delete(df.sparkSession, path)


_collecting: list[list[str]] = []  # copies staged inside the open calls of :func:`settled`


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str = "result") -> DataFrame:
    """What ``build`` returns, staged; the copies that were staged while building are deleted, also after an error."""
    from tidemark.sinks import files
    made: list[str] = []
    _collecting.append(made)
    try:
        df = build()
        result_path = scratch_path(spark, label)
        df.write.parquet(result_path)
    finally:
        _collecting.pop()
        for path in made:
            files.delete(spark, path)
    if _collecting:
        _collecting[-1].append(result_path)
    return spark.read.schema(df.schema).parquet(result_path)


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """:func:`stage` for the time of one block; the copy is deleted at its end, also after an error.

    Only for results that are written inside the block, as a DataFrame that reads the copy later finds it gone.
    """
    from tidemark.sinks import files
    path = scratch_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files.delete(df.sparkSession, path)
