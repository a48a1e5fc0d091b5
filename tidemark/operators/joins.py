"""Key-based lookups, updates and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import quote_name
from tidemark.operators.ordered import running_sum


def without_parent(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    keys = parent.select(F.col(quote_name(field)).alias("_key")).distinct()
    child = child.where(F.col(quote_name(column)).isNotNull())
    return child.join(keys, child[quote_name(column)] == keys["_key"], "left_anti")


def matching(df: DataFrame, column: str, keys: DataFrame, field: str) -> DataFrame:
    """Rows whose key is in a list held as a table (an ``IN`` list of any length)."""
    listed = keys.select(F.col(quote_name(field)).alias("_key"))
    return df.join(listed, df[quote_name(column)] == listed["_key"], "left_semi")


def set_difference(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None,
                   counted: bool = False) -> DataFrame:
    """Rows in only one of two tables, tagged ``a_minus_b`` or ``b_minus_a``.

    Set-based by default; ``counted`` compares how often each row occurs. One aggregation over both
    tables replaces two set differences and reads each table once.
    """
    cols = list(columns or a.columns)
    other = b.select(*[F.col(quote_name(c)) for c in (columns or b.columns)]).toDF(*cols)
    both = (a.select(*[F.col(quote_name(c)) for c in cols]).withColumns({"_a": F.lit(1), "_b": F.lit(0)})
            .unionAll(other.withColumns({"_a": F.lit(0), "_b": F.lit(1)})))
    keys = [F.col(quote_name(c)) for c in cols]
    counts = both.groupBy(*keys).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    side = F.when(F.col("_a") > F.col("_b"), "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    if not counted:
        return counts.where("(_a > 0 and _b = 0) or (_b > 0 and _a = 0)").select(side, *keys)
    times = F.abs(F.col("_a") - F.col("_b")).cast("int")
    return counts.where("_a <> _b").select(side, *keys, times.alias("copies"))


def update_by_key(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Old rows with non-null new values written over them; keys only in ``new`` are ignored."""
    fresh = new.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = old.join(fresh, old[key] == fresh["_key"], "left")
    return joined.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
                           for c in old.columns])


def changed_count(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """How many keys present in both versions differ in ``column`` (NULL differs from a value)."""
    a = old.select(key, F.col(column).alias("_old"))
    b = new.select(key, F.col(column).alias("_new"))
    return a.join(b, key).agg(F.count(F.lit(1)).alias("compared"),
                              F.count_if(~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"))


def available_at(orders: DataFrame, products: DataFrame, order_key: str = "order_id",
                 order_ts: str = "order_date", product_ts: str = "created_at") -> DataFrame:
    """Per order, how many products existed when it was placed (all of them if none did).

    Products are counted per timestamp and merged with the orders on one time line, where a running count is
    taken, so no order ever meets a product in a join.
    """
    arrivals = products.groupBy(F.col(product_ts).alias("at")).agg(F.count(F.lit(1)).alias("n")).select(
        "at", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias(order_key), "n")
    asks = orders.select(F.col(order_ts).alias("at"), F.lit(1).alias("kind"), F.col(order_key).cast("bigint"),
                         F.lit(0).cast("bigint").alias("n"))
    order = [F.col("at").asc_nulls_last(), F.col("kind").asc(), F.col(order_key).asc()]
    counted = running_sum(arrivals.unionByName(asks), order, F.col("n"), "available")
    total = products.agg(F.count(F.lit(1))).scalar()
    return counted.where("kind = 1").select(
        order_key, F.when(F.col("available") > 0, F.col("available")).otherwise(total).alias("available"))


def with_lookup(df: DataFrame, on: str, lookup: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Left join on one key, with a default for every looked-up column of an unmatched row.

    A matched row keeps its values, NULLs included.
    """
    found = lookup.select(on, *defaults, F.lit(True).alias("_found"))
    joined = df.join(found, on, "left")
    return joined.withColumns({c: F.when(F.col("_found"), F.col(c)).otherwise(d)
                               for c, d in defaults.items()}).drop("_found")
