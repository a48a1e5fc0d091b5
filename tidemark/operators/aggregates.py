"""Aggregates with the tie and limit rules used across the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import quote_name
from tidemark.operators.dedupe import first_per_key


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def mode_per_key(df: DataFrame, keys: Sequence[str], value: str, latest: str) -> DataFrame:
    """Most frequent value per key; ties go to the value used last, then to the greatest value.

    Counting per (key, value) first means a hot key reaches the second step as a few rows.
    """
    counted = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
               .agg(F.count(F.lit(1)).alias("_n"), F.max(latest).alias("_latest")))
    best = F.max(F.struct("_n", "_latest", F.col(value).alias("v")))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col("_best")["v"].alias(value), F.col("_best")["_n"].alias("uses"))


def listagg(df: DataFrame, keys: Sequence[str], measure: str, delimiter: str = ",", distinct: bool = False, order_by: str | None = None,
            descending: bool = False, name: str = "joined") -> DataFrame:
    """Values of each group joined by a delimiter, NULLs left out; ordered by the value unless told otherwise, NULL without any value.

    Distinct values can only be ordered by themselves, and numbers are ordered as numbers. The joined text holds the whole group by
    definition, so use it on keys of modest size; with a limit, :func:`listagg_first` sends only the wanted rows.
    """
    if distinct and order_by not in (None, measure):
        raise ValueError("distinct values can only be ordered by themselves")
    if distinct:  # one row per value first: smaller groups, and any type may be ordered
        df = df.select(*[quote_name(k) for k in keys], quote_name(measure)).distinct()  # NULL among them, so a group without any value stays
    direction = "DESC" if descending else "ASC"
    value, ordinal = quote_name(measure), quote_name(order_by or measure)
    text = f"CASE WHEN {value} IS NOT NULL THEN CAST({value} AS STRING) END"
    # the delimiter must be a literal here
    literal = delimiter.replace("\\", "\\\\").replace("'", "\\'")
    joined = F.expr(f"listagg({text}, '{literal}') WITHIN GROUP (ORDER BY {ordinal} {direction} NULLS LAST, {value} {direction})")
    return df.groupBy(*[quote_name(k) for k in keys]).agg(joined.alias(name))


def listagg_first(df: DataFrame, keys: Sequence[str], measure: str, order_by: Sequence[Column], limit: int,
                  delimiter: str = ",", name: str = "joined") -> DataFrame:
    """The first ``limit`` values of each key joined; the rank filter keeps ``limit`` rows per key and task
    before the shuffle, so group size does not matter."""
    from pyspark.sql import Window
    ranked = (df.where(F.col(measure).isNotNull())
              .withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
              .where(F.col("_rn") <= limit))
    items = F.array_sort(F.collect_list(F.struct("_rn", F.col(measure).cast("string").alias("v"))))
    return ranked.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x["v"]), delimiter).alias(name))


def not_null_share(c: Column) -> Column:
    """Share of rows that hold a value."""
    return F.avg(c.isNotNull().cast("double"))


def watermark(df: DataFrame, ts: str = "_ingestion_ts", initial: str = "1970-01-01 00:00:00") -> DataFrame:
    """One row: the greatest timestamp, or the initial one for an empty table."""
    return df.agg(F.coalesce(F.max(ts), F.lit(initial).cast("timestamp")).alias("watermark"))


def category_counts(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Purchases per customer and product category.

    Items are counted per (order, product) before they meet the other tables.
    """
    counted = items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return (counted.join(products.select("product_id", "category"), "product_id")
            .join(orders.select("order_id", "customer_id"), "order_id")
            .groupBy("customer_id", "category").agg(F.sum("n").alias("purchases")))


def order_subtotals(items: DataFrame) -> DataFrame:
    """Sum of rounded line totals per order."""
    line = F.round(F.col("unit_price") * F.col("quantity"), 2)
    return items.groupBy("order_id").agg(F.round(F.sum(line), 2).alias("subtotal"), F.count(F.lit(1)).alias("n_lines"))


__all__ = ["category_counts", "first_per_key", "group_by_first", "listagg", "listagg_first", "mode_per_key",
           "not_null_share", "order_subtotals", "watermark"]
