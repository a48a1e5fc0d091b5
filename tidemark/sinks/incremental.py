"""Incremental writes to partitioned Parquet folders."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quote_name
from tidemark.functions.timestamps import aware, date_or_null, datediff, utc
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.filters import newer_than, newest
from tidemark.session import staged
from tidemark.sinks import files, versioned

ROWS_PER_FILE = 100_000  # fixed value: largest file of an appended partition


def read_target(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, plain or versioned, or None before the first run.

    With a schema no file footer is opened to find one; columns a file lacks are NULL, others are ignored.
    """
    if versioned.exists(spark, path):
        return versioned.read(spark, path, schema)
    recover_files(spark, path)
    if not files.exists(spark, path):
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Full replacement of a catalogue table (external when a path is given)."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together, so that each is written as few files; a partition too large for one
    task is split by the adaptive rebalance."""
    return df.hint("rebalance", *[F.col(p) for p in partition_by]) if partition_by else df


def insert_overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces every partition that occurs in ``df`` and leaves the others alone. ``df`` may read ``path``:
    it is staged before anything is replaced."""
    with staged(df, "overwrite") as rows:
        writer = clustered(rows, partition_by).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)


def incremental_overwrite(source: DataFrame, build: Callable[[DataFrame], DataFrame], path: str,
                          partition_by: Sequence[str], ts: str = "_ingestion_ts", target_ts: str | None = None,
                          full_refresh: bool = False) -> None:
    """Builds from the rows newer than the target and replaces the partitions the result holds.

    Rows of a replaced partition that were not delivered again are lost, and a key that moved to another
    partition exists twice; :func:`upsert` avoids both.
    """
    spark = source.sparkSession
    target = None if full_refresh else read_target(spark, path)
    built = build(newer_than(source, target, ts, target_ts))
    if full_refresh:
        with staged(built, "refresh") as rows:
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        insert_overwrite(built, path, partition_by)


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns of ``schema``: missing ones as NULL, extra ones dropped."""
    return df.select(*[(F.col(quote_name(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def upsert(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), version: str | None = None) -> None:
    """One row per key: new rows win, the others stay, and the columns follow the new rows.

    With ``version`` a new row wins only if its version is not older than the stored one, so that late batches may come in any order;
    no version is older than any.
    Only partitions that receive rows or lose an old version are rewritten; of the others just the keys are
    read. ``df`` must hold one row per key.
    """
    spark = df.sparkSession
    with staged(df, "upsert-new") as new:
        old = read_target(spark, path, new.schema)
        if old is None:
            insert_overwrite(new, path, partition_by)
            return
        if version:
            known = old.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(version).alias("_stored"))
            late = F.coalesce(known["_stored"] > new[version], known["_stored"].isNotNull() & new[version].isNull())
            older = [new[k].eqNullSafe(known[f"_k_{k}"]) for k in keys] + [late]
            with staged(new.join(known, older, "left_anti"), "upsert-newer") as newer:
                _merge(old, newer, path, keys, partition_by)
        else:
            _merge(old, new, path, keys, partition_by)


def _merge(old: DataFrame, new: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    spark = new.sparkSession
    fresh = new.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = [old[k].eqNullSafe(fresh[f"_k_{k}"]) for k in keys]
    if not partition_by:
        replace_files(old.join(fresh, same, "left_anti").unionByName(new), path)
        return
    parts = [F.col(p) for p in partition_by]
    # folders that get rows or lose a version, at most one row each; the scan below is pruned to them by a join
    touched = old.join(fresh, same, "left_semi").select(*parts).unionAll(new.select(*parts)).distinct()
    with staged(touched, "upsert-folders") as folders:
        named = folders.select(*[F.col(p).alias(f"_f_{p}") for p in partition_by])
        inside = [old[p].eqNullSafe(named[f"_f_{p}"]) for p in partition_by]
        kept = old.join(named, inside, "left_semi").join(fresh, same, "left_anti")
        with staged(kept.unionByName(new), "upsert") as result:
            if result.isEmpty() and folders.isEmpty():
                return
            (clustered(result, partition_by).write.mode("overwrite").partitionBy(*partition_by)
             .option("partitionOverwriteMode", "dynamic").parquet(path))
            # a dynamic overwrite never clears a partition that lost all its rows; those folders are deleted one by one
            filled = result.select(*[F.col(p).alias(f"_f_{p}") for p in partition_by]).distinct()
            emptied = folders.join(filled, [folders[p].eqNullSafe(filled[f"_f_{p}"]) for p in partition_by], "left_anti")
            for row in emptied.toLocalIterator():
                files.delete(spark, path + "".join(f"/{p}={folder_value(row[p])}" for p in partition_by))


def replace_files(df: DataFrame, path: str) -> None:
    """Replaces a whole folder of files by ``df``, which may read it. The old files go only when the new ones are complete.

    A run that breaks off in between leaves either the old folder, or the new rows beside it, where :func:`recover_files` finds them.
    """
    spark = df.sparkSession
    fresh, old = f"{path}__new", f"{path}__old"
    files.delete(spark, fresh)
    df.write.parquet(fresh)
    if files.exists(spark, path):
        files.delete(spark, old)
        files.rename(spark, path, old)
    files.rename(spark, fresh, path)
    files.delete(spark, old)


def recover_files(spark: SparkSession, path: str) -> None:
    """Undoes a :func:`replace_files` that broke off between its two renames."""
    if not files.exists(spark, path) and files.exists(spark, f"{path}__old"):
        files.rename(spark, f"{path}__old", path)


def folder_value(value) -> str:
    """A partition value as it appears in a folder name, where special characters are percent-encoded."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", str(value))


def merge_by_key(existing: DataFrame, new: DataFrame, key: str, order_by: Sequence[Column] = ()) -> DataFrame:
    """Union with one row per key; new rows win over existing ones, then ``order_by`` decides."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return first_per_key(both, [key], [F.col("_new").desc(), *order_by]).drop("_new")


def update_date_partitions(df: DataFrame, path: str, ts: str, key: str, start: date, end: date,
                           order_by: Sequence[Column] = ()) -> None:
    """Merges rows into the ``date=`` folders of a closed range by key and replaces those folders.

    The day comes from the timestamp text; unreadable days and days outside the range are skipped. A key is
    matched within its own day, as each folder is merged on its own.
    """
    spark = df.sparkSession
    day = F.to_date(ts) if not isinstance(df.schema[ts].dataType, T.StringType) else date_or_null(ts)
    new = df.withColumn("date", day).where(F.col("date").between(F.lit(start), F.lit(end)))
    old = read_target(spark, path)
    if old is not None:
        days = new.select("date").distinct()
        touched = old.where(F.col("date").between(F.lit(start), F.lit(end))).join(days, "date", "left_semi")
        both = (touched.withColumn("_new", F.lit(0))
                .unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True))
    else:
        both = new.withColumn("_new", F.lit(1))
    merged = first_per_key(both, ["date", key], [F.col("_new").desc(), *order_by]).drop("_new")
    insert_overwrite(merged, path, ["date"])


def append_partitions(df: DataFrame, path: str, partition_by: Sequence[str], rows_per_file: int = ROWS_PER_FILE,
                      gather: bool = True) -> None:
    """Appends rows in files of bounded size.

    Rows of a folder come together first, so that a task does not write a small file to each of many. Without ``gather`` every task writes
    what it has read: for few folders, where that costs neither a shuffle nor a sort of more rows than were read at a time.
    """
    rows = clustered(df, partition_by) if gather else df
    (rows.write.mode("append").option("maxRecordsPerFile", rows_per_file)
     .partitionBy(*partition_by).parquet(path))


PERIODS = {"hour": timedelta(hours=1), "day": timedelta(days=1), "week": timedelta(weeks=1)}


def add_periods(at: datetime, n: int, period: str) -> datetime:
    if period in PERIODS:
        return at + n * PERIODS[period]
    month = at.year * 12 + at.month - 1 + n * {"month": 1, "year": 12}[period]
    year, month0 = divmod(month, 12)
    for day in range(at.day, 27, -1):
        try:
            return at.replace(year=year, month=month0 + 1, day=day)
        except ValueError:
            continue
    return at.replace(year=year, month=month0 + 1)


def period_boundaries(spark: SparkSession, path: str, ts: str, start: datetime, stop: datetime | None,
                      period: str = "week", now: datetime | None = None) -> tuple[datetime, datetime, int]:
    """Start, stop and number of periods of the next run: from the newest stored row (or ``start``) to one
    millisecond before ``stop`` (or now)."""
    target = read_target(spark, path)
    stored = newest(target, ts) if target is not None else 0
    begin = utc(stored) if stored else aware(start)
    end = aware(stop) - timedelta(milliseconds=1) if stop else aware(now or datetime.now(timezone.utc))
    n = spark.range(1).select(datediff(period, F.lit(begin), F.lit(end)).alias("n")).first()["n"] + 1
    return begin, end, n


def insert_by_period(build: Callable[[Column], DataFrame], path: str, ts: str, start: datetime,
                     stop: datetime | None = None, period: str = "week", spark: SparkSession | None = None,
                     now: datetime | None = None) -> int:
    """Appends period by period, so that a broken run resumes after the last finished one.

    ``build(period_filter)`` returns the rows of one period; the filter is a plain range on ``ts`` that
    reaches the scan. Returns the number of periods.
    """
    spark = spark or SparkSession.getActiveSession()
    begin, end, periods = period_boundaries(spark, path, ts, start, stop, period, now)
    for i in range(periods):
        low, high = add_periods(begin, i, period), add_periods(begin, i + 1, period)
        inside = (F.col(ts) > F.lit(low)) & (F.col(ts) <= F.lit(high)) & (F.col(ts) < F.lit(end))
        build(inside).write.mode("append").parquet(path)
    return max(periods, 0)


def export_tables(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One Parquet folder per table."""
    paths = {name: f"{root}/{name}" for name in tables}
    for name, df in tables.items():
        replace_files(df, paths[name])
    return paths


def reload_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Exported tables again; run constraint checks (key unique and set, parents present) on the result."""
    return {name: spark.read.parquet(path) for name, path in paths.items()}
