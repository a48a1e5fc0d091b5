"""What was known about a customer when an order was placed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import running_sums

SPEND_DAYS = 180  # fixed value: look-back of the recent spend


def _totals_before(lines: DataFrame) -> DataFrame:
    """Adds ``n_before`` and ``amount_before``: all earlier order lines of the same customer.

    Running totals over slices of the sorted lines: a customer with a third of all orders, even of one day, is spread over many tasks.
    """
    order = [F.col(c).asc() for c in ("at", "kind", "order_id")]
    totals = running_sums(lines, order, {"n_until": F.col("n"), "amount_until": F.col("amount")}, ["customer_id"])
    return totals.withColumns({"n_before": F.col("n_until") - F.col("n"), "amount_before": F.col("amount_until") - F.col("amount")})


def order_history(orders: DataFrame, days: int = SPEND_DAYS) -> DataFrame:
    """Per order: number of earlier orders of the customer and their amount in the last ``days`` days.

    Earlier means before in time, ties by order id. The recent amount is a difference of two running
    totals: up to the order, minus up to the start of the look-back. For that each order also places a
    marker without value at its look-back start; both are brought together by order id.
    """
    o = orders.select("customer_id", "order_id", "order_date", F.col("total_amount").alias("amount"))
    rows = o.select("customer_id", "order_id", F.col("order_date").alias("at"), F.lit(1).alias("kind"),
                    F.lit(1).cast("bigint").alias("n"), "amount")
    markers = o.select("customer_id", "order_id", F.timestamp_add("DAY", F.lit(-days), F.col("order_date")).alias("at"),
                       F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("n"),
                       F.lit(0).cast(o.schema["amount"].dataType).alias("amount"))
    totals = _totals_before(rows.unionByName(markers))
    order, marker = F.col("kind") == 1, F.col("kind") == 0
    return totals.groupBy("order_id").agg(
        F.max(F.when(order, F.col("customer_id"))).alias("customer_id"),
        F.max(F.when(order, F.col("at"))).alias("order_date"),
        F.max(F.when(order, F.col("n_before"))).alias("previous_orders"),
        (F.max(F.when(order, F.col("amount_before"))) - F.max(F.when(marker, F.col("amount_before")))).alias("recent_spend"))
