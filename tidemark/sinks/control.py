"""Checkpoints, run log and the window of the next load. All tables here hold a few rows per entity or run."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import aware, utc
from tidemark.operators.filters import newest
from tidemark.sinks import files
from tidemark.sinks.incremental import read_target

CHECKPOINT_SCHEMA = "entity string, last_sync_timestamp timestamp, record_count bigint, updated_at timestamp"
RUN_SCHEMA = ("run_date timestamp, last_processed_date date, status string, records_processed map<string,bigint>, "
              "error_message string")


def ensure_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The newest checkpoint of each entity; the folder is created empty if absent.

    Checkpoints are only ever appended, so a write that breaks off leaves the earlier ones as they were.
    """
    if not files.exists(spark, path):
        spark.createDataFrame([], CHECKPOINT_SCHEMA).write.parquet(path)
    written = spark.read.schema(CHECKPOINT_SCHEMA).parquet(path)
    latest = F.max(F.struct("updated_at", "last_sync_timestamp", "record_count"))
    return written.groupBy("entity").agg(latest.alias("l")).select(
        "entity", "l.last_sync_timestamp", "l.record_count", "l.updated_at")


def get_last_sync(spark: SparkSession, path: str, entity: str) -> datetime:
    """Last sync of an entity, in UTC without zone; the initial date when there is none."""
    rows = ensure_checkpoints(spark, path).where(F.col("entity") == entity)
    return utc(newest(rows, "last_sync_timestamp")).replace(tzinfo=None)


def update_sync(spark: SparkSession, path: str, entity: str, synced: datetime, records: int,
                now: datetime | None = None) -> None:
    """Appends a checkpoint; the newest by ``now`` counts."""
    row = spark.createDataFrame([(entity, aware(synced), records, aware(now or datetime.now(timezone.utc)))], CHECKPOINT_SCHEMA)
    row.write.mode("append").parquet(path)


def load_type(spark: SparkSession, path: str, requested: str = "incremental") -> str:
    """``full`` on a first run, when no entity has a checkpoint yet; else as requested."""
    return "full" if ensure_checkpoints(spark, path).isEmpty() else requested.lower()


def reset(spark: SparkSession, bronze_root: str, checkpoint_path: str) -> None:
    """Drops all landed data and checkpoints; the next run is a full one."""
    files.delete(spark, bronze_root)
    files.delete(spark, checkpoint_path)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def write_run_log(spark: SparkSession, path: str, processed: date, status: str, records: dict[str, int] | None = None,
                  error: str | None = None, now: datetime | None = None) -> None:
    at = aware(now or datetime.now(timezone.utc))
    append_runs(spark.createDataFrame([(at, processed, status, records or {}, error)], RUN_SCHEMA), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log, empty before the first run."""
    return spark.read.schema(RUN_SCHEMA).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], RUN_SCHEMA)


def last_run_date(runs: DataFrame) -> DataFrame:
    """One row: the last processed date of the newest successful run, NULL without one."""
    done = runs.where("status = 'success' and last_processed_date is not null")
    newest = F.max(F.struct("run_date", "last_processed_date"))
    return done.agg(newest["last_processed_date"].alias("last_processed_date"))


def load_window(last_run: DataFrame, max_order_date: DataFrame, as_of: Column, initial_start: Column) -> DataFrame:
    """One row: mode, start and end of the next load.

    The start is the day after the last processed one, else the day after the newest order, else the initial
    start; the end is yesterday; a start after the end means there is nothing to do. Both inputs hold one
    date in one row.
    """
    known = (last_run.select(F.col(last_run.columns[0]).alias("run"), F.lit(None).cast("date").alias("order"))
             .unionAll(max_order_date.select(F.lit(None).cast("date"), F.to_date(max_order_date.columns[0])))
             .agg(F.max("run").alias("run"), F.max("order").alias("order")))
    last = F.coalesce("run", "order")
    end = F.date_sub(as_of, 1)
    start = F.coalesce(F.date_add(last, 1), initial_start)
    mode = F.when(last.isNull(), "initial").when(start > end, "nothing").otherwise("ongoing")
    return known.select(mode.alias("mode"), start.alias("start_date"), end.alias("end_date"))


__all__ = ["append_runs", "ensure_checkpoints", "get_last_sync", "last_run_date", "load_type", "load_window",
           "read_target", "reset", "update_sync", "write_run_log"]
