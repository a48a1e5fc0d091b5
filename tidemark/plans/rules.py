"""Business rules on customers, orders, payments and shipments. Where the original rule draws lots, the
outcome is an input column or table here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import SPACE_FORMAT
from tidemark.operators.history import SPEND_DAYS, order_history
from tidemark.operators.joins import with_lookup

# Segment rules.
NEW_DAYS, NEW_ORDERS, VIP_SPEND = 60, 2, 6000
DISCOUNT_RATES = {"New": "0.10", "Regular": "0.05", "VIP": "0.10"}
FREE_SHIPPING = {"first": 0, "second": 40, "regular": 50, "vip": 20}

# Tax rate per country; these are also the countries with an own warehouse.
TAX_RATES = {"United States": "0.08", "Canada": "0.13", "United Kingdom": "0.20", "Germany": "0.19", "France": "0.20",
             "Italy": "0.22", "Spain": "0.21", "Japan": "0.10", "Netherlands": "0.21", "Australia": "0.10"}
HOME = "United States"
NO_POSTAL_CODE = "00000"

# Average days of processing, shipping and delivery.
PROCESSING_DAYS, SHIPPING_DAYS, DELIVERY_DAYS = 1, 3, 5
FULFILMENT_DAYS = PROCESSING_DAYS + SHIPPING_DAYS + DELIVERY_DAYS


def _complete_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days, rounded down also for negative spans."""
    return F.floor((F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))) / 86400)


def _lookup(values: dict[str, str], key: Column, type_name: str) -> Column:
    """A small fixed mapping as one CASE; NULL for unknown keys."""
    branches = reduce(lambda w, kv: w.when(key == kv[0], F.lit(kv[1]).cast(type_name)), list(values.items())[1:],
                      F.when(key == next(iter(values)), F.lit(next(iter(values.values()))).cast(type_name)))
    return branches


def _segment(is_subscriber: Column, days: Column, orders: Column, spend: Column) -> Column:
    return (F.when(is_subscriber, "VIP")
            .when((days < NEW_DAYS) | (orders < NEW_ORDERS), "New")
            .when(spend > VIP_SPEND, "VIP").otherwise("Regular"))


def _subscribed(df: DataFrame, subscribers: DataFrame) -> DataFrame:
    ids = subscribers.select("customer_id", F.lit(True).alias("_vip")).distinct()
    return df.join(ids, "customer_id", "left").withColumn("_vip", F.coalesce("_vip", F.lit(False)))


def update_customer_segments(customers: DataFrame, orders: DataFrame, subscribers: DataFrame, as_of: Column) -> DataFrame:
    """Current segment per customer; ``updated_at`` moves only when the segment does."""
    now = as_of.cast("timestamp")
    recent = F.col("order_date") >= F.timestamp_add("DAY", F.lit(-SPEND_DAYS), now)
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_orders"), F.sum(F.when(recent, F.col("total_amount"))).alias("_spend"))
    joined = _subscribed(customers.join(per_customer, "customer_id", "left"), subscribers)
    segment = _segment(F.col("_vip"), _complete_days(F.col("signup_date"), now),
                       F.coalesce("_orders", F.lit(0)), F.coalesce("_spend", F.lit(0)))
    moved = ~F.col("customer_segment").eqNullSafe(F.col("_segment"))
    return (joined.withColumn("_segment", segment)
            .withColumn("updated_at", F.when(moved, now).otherwise(F.col("updated_at")))
            .withColumn("customer_segment", F.col("_segment")).select(*customers.columns))


def segment_at_order(orders: DataFrame, customers: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Segment each customer had when ordering, from earlier orders only."""
    known = order_history(orders).join(customers.select("customer_id", "signup_date"), "customer_id")
    df = _subscribed(known, subscribers)
    segment = _segment(F.col("_vip"), _complete_days(F.col("signup_date"), F.col("order_date")),
                       F.col("previous_orders"), F.col("recent_spend"))
    return df.select("order_id", "customer_id", "previous_orders", "recent_spend", segment.alias("segment"))


def progress_orders(orders: DataFrame, as_of: Column, refunded: DataFrame | None = None) -> DataFrame:
    """Moves orders along processing, shipped and delivered by age, fills the missing dates, and refunds the
    delivered and paid orders listed in ``refunded`` five days after delivery or later. Cancelled and refunded
    orders stay as they are, and ``updated_at`` moves only with a change."""
    now, placed = as_of.cast("timestamp"), F.col("order_date")
    age = _complete_days(placed, now)
    if refunded is not None:
        orders = orders.join(refunded.select("order_id", F.lit(True).alias("_listed")).distinct(), "order_id", "left")
    else:
        orders = orders.withColumn("_listed", F.lit(False))
    status = F.col("order_status")
    ships = (status == "processing") & (age >= PROCESSING_DAYS)
    arrives = (status == "shipped") & (age >= FULFILMENT_DAYS)
    refunds = ((status == "delivered") & (F.col("payment_status") == "completed") & F.coalesce("_listed", F.lit(False))
               & (_complete_days(F.col("delivered_date"), now) >= 5))
    changed = F.coalesce(ships | arrives | refunds, F.lit(False))

    def fill(condition: Column, c: str, days: int) -> Column:
        return F.when(condition & F.col(c).isNull(), F.timestamp_add("DAY", F.lit(days), placed)).otherwise(F.col(c))

    return orders.withColumns({
        "order_status": F.when(ships, "shipped").when(arrives, "delivered").when(refunds, "refunded").otherwise(status),
        "payment_status": F.when(refunds, "refunded").otherwise(F.col("payment_status")),
        "shipment_date": fill(ships, "shipment_date", PROCESSING_DAYS),
        "delivered_date": fill(arrives, "delivered_date", FULFILMENT_DAYS),
        "updated_at": F.when(changed, now).otherwise(F.col("updated_at")),
    }).drop("_listed")


def derive_payments(orders: DataFrame) -> DataFrame:
    """Payment records of the orders that have a payment id. A refund is dated at delivery, when there is one."""
    paid = F.coalesce("payment_date", "order_date")
    refunded = (F.col("payment_status") == "refunded") & F.col("delivered_date").isNotNull()
    text = F.date_format(paid, SPACE_FORMAT)
    updated = F.when(refunded, F.date_format("delivered_date", SPACE_FORMAT)).otherwise(text)
    return orders.where("payment_id is not null").select(
        F.col("payment_id").cast("bigint").alias("payment-id"), F.col("order_id").alias("order-id"),
        F.col("customer_id").alias("customer-id"), F.col("payment_method").alias("payment-method"),
        F.col("total_amount").alias("amount"), F.col("payment_status").alias("payment-status"),
        text.alias("payment-date"), text.alias("created-at"), updated.alias("updated-at"))


def with_destination(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds destination country and postal code of the customer (home defaults for an unknown customer) and
    the country of the warehouse that serves it."""
    lookup = customers.select("customer_id", F.col("country").alias("destination_country"),
                              F.col("postal_code").alias("destination_postal_code"))
    found = with_lookup(orders, "customer_id", lookup, {"destination_country": F.lit(HOME),
                                                        "destination_postal_code": F.lit(NO_POSTAL_CODE)})
    served = F.col("destination_country").isin(list(TAX_RATES))
    return found.withColumn("origin_country", F.when(served, F.col("destination_country")).otherwise(HOME))


def tracking_code(carrier: Column, number: Column) -> Column:
    """Carrier-styled code from the md5 of carrier and number."""
    code = F.upper(F.substring(F.md5(F.concat_ws("|", carrier, number.cast("string"))), 1, 12))
    spaced = F.concat_ws(" ", *[F.substring(code, start, 4) for start in (1, 5, 9)])
    return (F.when(carrier == "UPS", F.concat(F.lit("1Z"), code)).when(carrier.isin("FedEx", "USPS"), spaced)
            .otherwise(code))


def shipment_status(shipped: Column, delivered: Column) -> Column:
    return F.when(delivered.isNotNull(), "delivered").when(shipped.isNotNull(), "in_transit").otherwise("pending")


def overdue_band(shipped: Column, delivered: Column, as_of: Column) -> Column:
    """How late a shipment on its way is, counted from the estimated delivery; NULL when it is not on its way."""
    late = _complete_days(F.timestamp_add("DAY", F.lit(DELIVERY_DAYS), shipped), as_of)
    band = (F.when(late > 7, "over_7_days").when(late > 4, "over_4_days").when(late > 2, "over_2_days")
            .otherwise("on_time"))
    return F.when(shipped.isNotNull() & delivered.isNull(), band)


def derive_shipments(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Shipment records of the orders that have a tracking number."""
    sent = with_destination(orders.where("tracking_number is not null"), customers)
    shipped, delivered = F.col("shipment_date"), F.col("delivered_date")

    def text(c: Column) -> Column:
        return F.date_format(c, SPACE_FORMAT)

    number = F.col("tracking_number").cast("bigint")
    return sent.select(
        number.alias("tracking_number"), tracking_code(F.col("shipping_carrier"), number).alias("tracking_code"),
        "order_id", "shipping_carrier", "origin_country", "destination_country", "destination_postal_code",
        shipment_status(shipped, delivered).alias("status"), "shipping_cost",
        text(shipped).alias("shipment-date"),
        text(F.timestamp_add("DAY", F.lit(DELIVERY_DAYS), shipped)).alias("estimated-delivery-date"),
        text(delivered).alias("actual-delivery-date"), text(shipped).alias("created-at"),
        text(F.coalesce(delivered, shipped)).alias("updated-at"))


def price_orders(subtotals: DataFrame, takes_discount: Column) -> DataFrame:
    """Discount by segment, tax by country on the reduced sum, and the total; each step rounded to cents.

    ``subtotals`` holds order_id, subtotal, segment, country and shipping_cost.
    """
    money = "decimal(18,2)"
    rate = _lookup(DISCOUNT_RATES, F.col("segment"), "decimal(3,2)")
    tax = _lookup(TAX_RATES, F.col("country"), "decimal(3,2)")
    discount = F.when(takes_discount, F.round(F.col("subtotal") * rate, 2)).otherwise(F.lit(0)).cast(money)
    return (subtotals.withColumn("discount_amount", discount)
            .withColumn("tax_amount", F.round((F.col("subtotal") - F.col("discount_amount")) * tax, 2).cast(money))
            .withColumn("total_amount", (F.col("subtotal") - F.col("discount_amount") + F.col("tax_amount")
                                         + F.col("shipping_cost")).cast(money)))


def free_shipping_threshold(segment: Column, ordinal: Column) -> Column:
    """Subtotal from which shipping is free: by segment, and for new customers by the number of the order."""
    return (F.when(segment == "VIP", FREE_SHIPPING["vip"])
            .when((segment == "New") & (ordinal == 1), FREE_SHIPPING["first"])
            .when((segment == "New") & (ordinal == 2), FREE_SHIPPING["second"])
            .otherwise(FREE_SHIPPING["regular"]))


def orders_to_derive(new: DataFrame, updated: DataFrame) -> DataFrame:
    """New and updated orders together: those whose payments and shipments are derived again."""
    return new.unionByName(updated)


def status_band(order_date: Column, payment_status: Column, as_of: Column) -> Column:
    """Statuses an order of that age may have, ``|``-joined where the rule leaves a choice."""
    age = _complete_days(order_date, as_of)
    return (F.when(payment_status == "failed", "cancelled").when(payment_status == "pending", "pending")
            .when(age > FULFILMENT_DAYS, "delivered|refunded")
            .when(age > PROCESSING_DAYS + SHIPPING_DAYS, "shipped|delivered")
            .when(age > PROCESSING_DAYS, "processing|shipped").otherwise("processing"))
