"""Streaming variants of the batch tables. A file stream delivers new files once; ``available_now`` runs
one catch-up pass and stops, which makes a scheduled job of it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from tidemark.operators.dedupe import first_per_key
from tidemark.session import staged
from tidemark.sinks import versioned
from tidemark.sinks.incremental import read_target, upsert

LATE_ARRIVAL = "7 days"  # fixed value: how long a day stays open


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = LATE_ARRIVAL) -> DataFrame:
    """One row per key where rows are known to arrive within the delay: older state is dropped, and older rows with it.

    :func:`new_keys_to` has no such limit.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_windows(stream: DataFrame, ts: str, amount: str, delay: str = LATE_ARRIVAL) -> DataFrame:
    """Rows and amount per day, each day given once, when the watermark has passed it; rows later than that are dropped.

    Only where rows are known to arrive within the delay; :func:`daily_parts_to` has no such limit.
    """
    return (stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).alias("amount"))
            .select(F.to_date("window.start").alias("day"), "n_rows", "amount"))


def available_now(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    """Hands every micro-batch to ``each_batch`` until all present files are read. The checkpoint makes a
    rerun start after the last finished batch, so ``each_batch`` must tolerate one repetition."""
    return (stream.writeStream.foreachBatch(each_batch).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that replaces its own batch folder, so a repeated batch is not written twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch")
         .option("partitionOverwriteMode", "dynamic").parquet(path))
    return write


def new_keys_to(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch writer that appends the rows whose key no other batch has written: the table itself is the state.

    Rows may arrive at any time and in any order. A repeated batch replaces its own folder.
    """
    append = append_to(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = read_target(batch.sparkSession, path)
        rows = batch.dropDuplicates(list(keys))
        if stored is not None:
            rows = rows.join(stored.where(F.col("batch") != batch_id).select(*keys), list(keys), "left_anti")
        with staged(rows, "new-keys") as fresh:
            append(fresh, batch_id)
    return write


def first_of_each(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row of every key, whenever the others come: the keys are kept as state, dealt by key over the tasks.

    A batch looks up its own keys and never reads what was written. The state grows with the number of keys, so it belongs in a store on
    disk (:func:`keep_state_on_disk`); its checkpoint must be kept as long as the table.
    """
    return stream.dropDuplicates(list(keys))


def keep_state_on_disk(spark: SparkSession) -> None:
    """State of streams in RocksDB, with changes instead of whole snapshots in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def daily_parts_to(path: str, ts: str, amount: str) -> Callable[[DataFrame, int], None]:
    """Batch writer of rows and amount per day of each batch, to be summed by :func:`daily_totals`."""
    append = append_to(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).alias("amount")), batch_id)
    return write


def daily_totals(parts: DataFrame) -> DataFrame:
    """Rows and amount of every day so far, open ones included, whatever the batches and their order."""
    return parts.groupBy("day").agg(F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("amount"))


def latest_to(path: str, keys: Sequence[str], version: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps the highest version of each key; an older one that arrives later changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        newest = first_per_key(batch, list(keys), [F.col(version).desc_nulls_last()])
        upsert(newest, path, list(keys), list(partition_by), version=version)
    return write


def merged_to(path: str, keys: Sequence[str], version: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """:func:`latest_to` into a versioned table: a batch shows as a whole or not at all, and reads only pieces that may hold its keys.

    A repeated batch finds its own versions and writes the same rows again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        newest = first_per_key(batch, list(keys), [F.col(version).desc_nulls_last()])
        versioned.merge(newest, path, list(keys), list(partition_by), version=version)
    return write
