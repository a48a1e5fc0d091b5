"""Cleaned, typed, deduplicated tables: one row per key, the newest version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import complete_years, parse_any, parse_timestamp_safe
from tidemark.operators.dedupe import latest_per_key

AUDIT = ["_ingestion_ts", "_source_system", "_record_hash", "ingestion_date"]

# The e-mail pattern, the statuses that count as paid, the known shipment statuses.
EMAIL_PATTERN = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
PAID = ["completed", "success"]
ADULT_AGE = 18


def _flag(condition: Column) -> Column:
    """A condition as a strict boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def has_text(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(c) != "")


def stg_customers(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    email = F.lower(F.trim("email"))
    return latest_per_key(bronze, ["customer_id"]).select(
        "customer_id", "first_name", "last_name", email.alias("email"), "phone",
        "country", "city", "state", "postal_code", "address",
        "signup_date", "created_at", "updated_at", "customer_segment", "date_of_birth", "gender",
        _flag(email.rlike(EMAIL_PATTERN)).alias("is_valid_email"),
        (complete_years(F.col("date_of_birth"), today) >= ADULT_AGE).alias("is_adult"),
        _flag(has_text("email") | has_text("phone")).alias("has_contact"),
        *AUDIT)


def stg_orders(bronze: DataFrame) -> DataFrame:
    status, paid = F.lower("order_status"), F.lower("payment_status")
    return latest_per_key(bronze, ["order_id"]).select(
        "order_id", "customer_id", "order_date", "payment_date", "shipment_date", "delivered_date",
        "created_at", "updated_at", status.alias("order_status"), paid.alias("payment_status"),
        "subtotal", "discount_amount", "tax_amount", "shipping_cost", "total_amount",
        F.lower("payment_method").alias("payment_method"),
        F.col("payment_id").cast("bigint").alias("payment_id"),
        "shipping_carrier",
        F.col("tracking_number").cast("string").alias("tracking_number"),
        "customer_segment_at_order",
        _flag(paid.isin(PAID)).alias("is_paid"),
        (_flag(status == "delivered") | F.col("delivered_date").isNotNull()).alias("is_delivered"),
        (_flag(status == "refunded") | _flag(paid == "refunded")).alias("is_refunded"),
        _flag(status == "cancelled").alias("is_cancelled"),
        *AUDIT)


def _parsed(names: dict[str, str]) -> dict[str, Column]:
    """Timestamp and parse-error columns for ``{raw name: clean name}``."""
    return {name: c
            for raw, clean in names.items()
            for name, c in parse_timestamp_safe(raw, clean, parse_any).items()}


def _latest_parsed(bronze: DataFrame, key: str, names: dict[str, str]) -> tuple[DataFrame, list[Column]]:
    """:func:`latest_per_key` and its parsed columns. They are parsed before the shuffle, as texts take several times their room."""
    parsed, prefix = _parsed(names), "_p_"
    rows = bronze.select("*", *[c.alias(prefix + name) for name, c in parsed.items()]).drop(*names)
    return latest_per_key(rows, [key]), [F.col(prefix + name).alias(name) for name in parsed]


def stg_payments(bronze: DataFrame) -> DataFrame:
    latest, parsed = _latest_parsed(bronze, "payment-id", {"payment-date": "payment_date", "created-at": "created_at", "updated-at": "updated_at"})
    return latest.select(
        F.col("`payment-id`").cast("bigint").alias("payment_id"),
        F.col("`order-id`").cast("bigint").alias("order_id"),
        F.col("`customer-id`").cast("bigint").alias("customer_id"),
        F.lower(F.col("`payment-method`")).alias("payment_method"),
        F.lower(F.col("`card-brand`")).alias("card_brand"),
        F.col("`card-last-4`").alias("card_last_4"),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        F.lower(F.col("`payment-status`")).alias("payment_status"),
        *parsed,
        *AUDIT)


def stg_products(bronze: DataFrame) -> DataFrame:
    return latest_per_key(bronze, ["product_id"]).select(
        "product_id", F.trim("product_name").alias("product_name"),
        F.lower(F.trim("category")).alias("category"), F.lower(F.trim("sub_category")).alias("sub_category"),
        F.trim("brand").alias("brand"), "price", "cost", "created_at",
        F.lower(F.trim("color")).alias("color"), *AUDIT)


def stg_shipments(bronze: DataFrame) -> DataFrame:
    latest, parsed = _latest_parsed(bronze, "tracking_number", {
        "shipment-date": "shipment_date", "estimated-delivery-date": "estimated_delivery_date",
        "actual-delivery-date": "actual_delivery_date", "created-at": "created_at", "updated-at": "updated_at"})
    return latest.select(
        F.col("tracking_number").cast("bigint").alias("tracking_number"), "tracking_code", "order_id",
        "shipping_carrier", "origin_country", "destination_country", "destination_postal_code",
        F.lower("status").alias("status"),
        F.col("shipping_cost").cast("decimal(10,2)").alias("shipping_cost"),
        *parsed,
        *AUDIT)


STAGING = {"customers": stg_customers, "orders": stg_orders, "payments": stg_payments,
           "products": stg_products, "shipments": stg_shipments}
