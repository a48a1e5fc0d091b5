"""Stable pages of a result."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import aware
from tidemark.operators.ordered import positions

EARLY = 10_000  # rows that tasks may keep and the driver may merge


def page(df: DataFrame, order_by: Sequence[Column], limit: int = 1000, offset: int = 0) -> DataFrame:
    """Rows ``offset .. offset+limit`` of one total order, the same order for every page.

    Early pages keep the first rows of every task. For a deep one the rows are counted by slices of the order, and only the slices that hold the
    page are sorted, over all tasks. To read on from a known row, :func:`page_after` is cheaper: it filters at the scan.
    """
    if offset + limit <= EARLY:
        return df.orderBy(*order_by).offset(offset).limit(limit)
    return positions(df, order_by, offset + 1, offset + limit, "_row").orderBy("_row").drop("_row")


def page_info(df: DataFrame, limit: int = 1000, offset: int = 0) -> DataFrame:
    """One row: total_count, count on this page, has_more and next_offset."""
    total = F.col("total_count")
    here = F.greatest(F.lit(0), F.least(F.lit(limit), total - offset))
    more = total > offset + limit
    return df.agg(F.count(F.lit(1)).alias("total_count")).select(
        "total_count", here.alias("count"), F.lit(limit).alias("limit"), F.lit(offset).alias("offset"),
        more.alias("has_more"), F.when(more, F.lit(offset + limit)).alias("next_offset"))


def page_after(df: DataFrame, ts: str, key: str, last: tuple | None, limit: int = 1000) -> DataFrame:
    """The page after the row ``(ts, key)``: a pushed-down filter instead of a deep offset.

    NULL timestamps sort last, in key order.
    """
    if last is not None:
        at = aware(last[0]) if isinstance(last[0], datetime) else last[0]
        last_ts, last_key = F.lit(at), F.lit(last[1])
        later_key = F.col(key) > last_key
        if last[0] is None:
            df = df.where(F.col(ts).isNull() & later_key)
        else:
            df = df.where(F.col(ts).isNull() | (F.col(ts) > last_ts) | ((F.col(ts) == last_ts) & later_key))
    return df.orderBy(F.col(ts).asc_nulls_last(), F.col(key)).limit(limit)
