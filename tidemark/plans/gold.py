"""Business tables built on the cleaned ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import first_per_key
from tidemark.operators.ordered import ntile_columns
from tidemark.plans.silver import PAID

LATE_DAYS = 7


def best_payment(payments: DataFrame) -> DataFrame:
    """One payment per order: completed ones first, then the latest."""
    return first_per_key(payments, ["order_id"], [
        (F.col("payment_status") == "completed").desc_nulls_last(),
        F.col("payment_date").desc_nulls_last(), F.col("payment_id").desc_nulls_last()])


def latest_shipment(shipments: DataFrame) -> DataFrame:
    """One shipment per order: the one that moved last."""
    moved = F.coalesce("actual_delivery_date", "shipment_date", "created_at")
    return first_per_key(shipments, ["order_id"],
                         [moved.desc_nulls_last(), F.col("tracking_number").desc_nulls_last()])


def order_facts(orders: DataFrame, payments: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders with their best payment and latest shipment; all three sides hold one row per order."""
    p = best_payment(payments.select("order_id", "payment_id", "payment_status", "payment_date", "amount")).select(
        "order_id", F.col("amount").alias("p_amount"), F.col("payment_date").alias("p_date"))
    s = latest_shipment(shipments.select(
        "order_id", "tracking_number", "status", "shipping_carrier", "shipment_date",
        "estimated_delivery_date", "actual_delivery_date", "created_at")).select(
        "order_id", F.col("status").alias("shipment_status"), F.col("shipping_carrier").alias("s_carrier"),
        F.col("tracking_number").cast("string").alias("s_tracking"), F.col("shipment_date").alias("s_date"),
        "estimated_delivery_date", "actual_delivery_date")
    return orders.join(p, "order_id", "left").join(s, "order_id", "left").select(
        "order_id", "customer_id", "order_date", "order_status", "payment_status", "payment_method",
        F.coalesce("p_amount", "total_amount").alias("payment_amount"),
        F.coalesce("p_date", "payment_date").alias("payment_date"),
        "shipment_status", F.coalesce("s_carrier", "shipping_carrier").alias("shipping_carrier"),
        F.coalesce("s_tracking", "tracking_number").alias("tracking_number"),
        F.col("s_date").alias("shipment_date"), "estimated_delivery_date", "actual_delivery_date",
        "subtotal", "discount_amount", "tax_amount", "shipping_cost", "total_amount",
        F.col("_ingestion_ts").alias("_ingestion_ts_orders"),
        F.to_date("order_date").alias("order_date_partition"))


def _per_order(total: Column, orders: Column) -> Column:
    """Average per order, two decimals, 0 when there are none."""
    return F.when(orders > 0, F.round(total / orders, 2)).otherwise(F.lit(0)).cast("decimal(38,2)")


def recent_days(facts: DataFrame, as_of: Column | None = None, days: int = LATE_DAYS) -> DataFrame:
    """Orders of the last days: the part that late arrivals may still change."""
    today = F.current_date() if as_of is None else as_of
    return facts.where(F.to_date("order_date") >= F.date_sub(today, days))


def daily_metrics(facts: DataFrame) -> DataFrame:
    """Daily figures. ``facts`` holds one row per order, so plain conditional counts replace distinct ones
    and everything is pre-aggregated before the only shuffle (one row per day and task)."""
    delivered = (F.col("shipment_status") == "delivered") | F.col("actual_delivery_date").isNotNull()
    total = F.col("total_amount")
    refund = F.when(total < 0, total).when(F.col("payment_status") == "refunded", -total).otherwise(F.lit(0))
    return (facts.where("order_date is not null")
            .groupBy(F.to_date("order_date").alias("day"))
            .agg(F.count("order_id").alias("total_orders"),
                 F.coalesce(F.sum(total), F.lit(0)).alias("total_revenue"),
                 F.count_if(F.col("payment_status").isin(PAID)).alias("paid_orders"),
                 F.count_if(delivered).alias("delivered_orders"),
                 F.coalesce(F.sum(refund), F.lit(0)).alias("refund_amounts"))
            .withColumn("avg_order_value", _per_order(F.col("total_revenue"), F.col("total_orders")))
            .select("total_orders", "total_revenue", "avg_order_value", "paid_orders", "delivered_orders",
                    "refund_amounts", "day"))


_BITS = 1 << 15  # of one bitmap


#: Which orders each distinct count of a day looks at.
def _counted() -> dict[str, Column]:
    delivered = (F.col("shipment_status") == "delivered") | F.col("actual_delivery_date").isNotNull()
    return {"total_orders": F.lit(True), "paid_orders": F.col("payment_status").isin(PAID), "delivered_orders": delivered}


def daily_order_sets(facts: DataFrame) -> DataFrame:
    """Per day, count and block of order numbers a bitmap of the orders: exact sets that merge over batches, days and months.

    An order delivered again sets a bit that is set. Blocks hold 32 768 consecutive numbers, so a bitmap has 4 KB at most
    and a day as many as its orders' numbers span.
    """
    order = F.col("order_id").cast("long")
    conditions = F.array(*[F.struct(F.lit(name).alias("measure"), condition.alias("holds")) for name, condition in _counted().items()])
    rows = (facts.where("order_date is not null and order_id is not null")
            .select(F.to_date("order_date").alias("day"), order.alias("order_id"), F.explode(conditions).alias("m")).where("m.holds"))
    return (rows.groupBy("day", F.col("m.measure").alias("measure"), F.floor(F.col("order_id") / _BITS).alias("block"))
            .agg(F.bitmap_construct_agg(F.pmod("order_id", F.lit(_BITS))).alias("orders")))


def merged_order_sets(sets: DataFrame, *by: Column) -> DataFrame:
    """Unions of sets: of the same day from several batches, or of all days of a month."""
    return sets.groupBy(*by, "measure", "block").agg(F.bitmap_or_agg("orders").alias("orders"))


def distinct_orders(sets: DataFrame, *by: str) -> DataFrame:
    """The exact numbers of distinct orders in ``sets``, which holds each (by, measure, block) once."""
    counts = {name: F.sum(F.when(F.col("measure") == name, F.bitmap_count("orders")).otherwise(0)) for name in _counted()}
    return sets.groupBy(*by).agg(*[n.cast("long").alias(name) for name, n in counts.items()])


def profile_parts(facts: DataFrame, orders: Column | None = None) -> DataFrame:
    """Orders, amount, first and latest use per customer (level 3), customer and payment method (1), customer and carrier (2).

    ``orders``: how many orders a row of ``facts`` stands for, one by default.
    """
    customer, method, carrier = (F.col(c) for c in ("customer_id", "payment_method", "shipping_carrier"))
    narrow = facts.select("customer_id", "payment_method", "shipping_carrier", "order_date", "total_amount", *([orders.alias("orders")] if orders is not None else []))
    uses = F.count(F.lit(1)) if orders is None else F.sum("orders")
    amount = F.sum("total_amount") if orders is None else F.sum(F.col("total_amount") * F.col("orders"))
    counted = (narrow.groupingSets([[customer], [customer, method], [customer, carrier]], customer, method, carrier)
               .agg(F.grouping_id().cast("int").alias("level"),
                    F.min("order_date").alias("first_use"), F.max("order_date").alias("latest_use"), uses.alias("uses"), amount.alias("amount")))
    value = F.when(F.col("level") == 1, method).when(F.col("level") == 2, carrier)
    return counted.select("customer_id", "level", value.alias("value"), "first_use", "latest_use", "uses", "amount")


def fold_profiles(parts: DataFrame) -> DataFrame:
    """Per customer: order dates, count, revenue and the preferred payment method and carrier.

    A preferred value is the most frequent one, then the one used last, then the first by name. Parts without uses do not count.
    """
    whole, by_method, by_carrier = (F.col("level") == n for n in (3, 1, 2))
    used = F.col("uses") > 0

    def preferred(level: Column) -> Column:
        # max of (uses, latest use); max_by over equal ranks would be arbitrary, so the value joins the rank
        best = F.max(F.when(level & used & F.col("value").isNotNull(), F.struct("uses", "latest_use", "value")))
        return best["value"]

    return parts.groupBy("customer_id").agg(
        F.max(F.when(whole, F.col("first_use"))).alias("first_order_date"),
        F.max(F.when(whole, F.col("latest_use"))).alias("last_order_date"),
        F.max(F.when(whole, F.col("uses"))).alias("total_orders"),
        F.max(F.when(whole, F.col("amount"))).alias("total_revenue"),
        preferred(by_method).alias("preferred_payment_method"),
        preferred(by_carrier).alias("preferred_shipping_carrier"))


def order_profile(facts: DataFrame) -> DataFrame:
    """Per customer, from one grouping-sets pass over the facts and a second, much smaller, aggregation of its rows."""
    return fold_profiles(profile_parts(facts))


def customer_profiles(customers: DataFrame, profiles: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customers with their profiles; those without orders have zeros."""
    today = F.current_date() if as_of is None else as_of
    orders, revenue = F.coalesce("total_orders", F.lit(0)), F.coalesce("total_revenue", F.lit(0))
    return customers.select("customer_id", "email").join(profiles, "customer_id", "left").select(
        "customer_id", "email", "first_order_date", "last_order_date",
        orders.alias("total_orders"), revenue.alias("total_revenue"),
        _per_order(revenue, orders).alias("avg_order_value"),
        F.datediff(today, F.to_date("last_order_date")).alias("days_since_last_order"),
        "preferred_payment_method", "preferred_shipping_carrier")


def customer_360(customers: DataFrame, facts: DataFrame, as_of: Column | None = None) -> DataFrame:
    return customer_profiles(customers, order_profile(facts), as_of)


def rfm_scores(profiles: DataFrame) -> DataFrame:
    """Quintiles of recency, frequency and revenue; ties are broken by customer id."""
    base = (profiles.where("total_orders > 0 and days_since_last_order is not null")
            .select("customer_id", F.col("days_since_last_order").alias("recency_days"),
                    F.col("total_orders").alias("frequency"), F.col("total_revenue").alias("monetary")))
    key = F.col("customer_id").asc()
    scored = ntile_columns(base, 5, {
        "r_tile": [F.col("recency_days").asc_nulls_last(), key],
        "f_score": [F.col("frequency").asc_nulls_last(), key],
        "m_score": [F.col("monetary").asc_nulls_last(), key],
    }).withColumn("r_score", 6 - F.col("r_tile"))
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return scored.select(
        "customer_id", "recency_days", "frequency", "monetary", *scores,
        F.concat(*[c.cast("string") for c in scores]).alias("rfm_score_string"),
        (scores[0] * 100 + scores[1] * 10 + scores[2]).alias("rfm_score_numeric"))


def product_catalog(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "sub_category", "brand", "price", "cost",
                           "created_at", "color")


def landed_rows(entities: dict[str, DataFrame]) -> DataFrame:
    """Rows per ingestion date, load type and entity, newest first. Each source is counted before the union."""
    counts = [df.groupBy("ingestion_date", "load_type").agg(F.count(F.lit(1)).alias("row_count"))
              .select("ingestion_date", "load_type", F.lit(name).alias("entity"), "row_count")
              for name, df in entities.items()]
    union = counts[0]
    for c in counts[1:]:
        union = union.unionByName(c)
    return union.orderBy(F.desc("ingestion_date"), "load_type", "entity")


def recent_runs(runs: DataFrame, date_column: str, as_of: Column | None = None, days: int = LATE_DAYS) -> DataFrame:
    """Rows dated within the last days, newest first."""
    today = F.current_date() if as_of is None else as_of
    return runs.where(F.col(date_column) > F.date_sub(today, days)).orderBy(F.desc(date_column))
