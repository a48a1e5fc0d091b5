"""Incremental and presence filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INITIAL = "1970-01-01 00:00:00"  # fixed value: watermark of an empty target
FINAL_STATUSES = ["cancelled", "refunded"]  # fixed values: orders that never change again


def instant(micros: int) -> Column:
    """A timestamp literal from microseconds since 1970, whatever the zone of the driver's machine."""
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def newest(df: DataFrame, ts: str) -> int:
    """The newest timestamp as microseconds since 1970, 0 for an empty table."""
    return df.agg(F.coalesce(F.unix_micros(F.max(F.col(ts).cast("timestamp"))), F.lit(0)).alias("m")).first()["m"]


def newer_than(source: DataFrame, target: DataFrame | None, ts: str = "_ingestion_ts",
               target_ts: str | None = None, folder: str | None = None) -> DataFrame:
    """Rows of ``source`` strictly newer than the newest row of ``target`` (all rows without a target).

    The watermark is one aggregate over one column of the target and goes into the filter as a literal, so that
    it reaches the scan of the source. ``folder`` names a partition column with the day of ``ts``: older folders
    are then not even listed as input.
    """
    if target is None:
        return source
    mark = instant(newest(target, target_ts or ts))
    rows = source.where(F.col(ts) > mark)
    return rows.where(F.col(folder) >= F.to_date(mark)) if folder else rows


def between_dates(df: DataFrame, column: Column, start: Column, end: Column) -> DataFrame:
    """Rows whose day lies in the closed range; unreadable or missing days drop out."""
    return df.where(F.to_date(column).between(start, end))


def has_text(c: Column) -> Column:
    """Neither NULL nor blank; never NULL itself."""
    return c.isNotNull() & (F.trim(c) != "")


def split_open_orders(orders: DataFrame) -> DataFrame:
    """Marks orders that may still change, so that one read serves both updates and history."""
    return orders.withColumn("is_open", ~F.lower("order_status").isin(FINAL_STATUSES))
