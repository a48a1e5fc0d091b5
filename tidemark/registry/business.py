"""Business rules over the commerce tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates, ordered
from tidemark.plans import rules
from tidemark.registry.core import as_of, query
from tidemark.registry.layers import staging

c = F.col

_NOW = "TIMESTAMP '2001-08-02'"
_SUBSCRIBERS = "SELECT customer_id FROM stg_customers WHERE gender = 'Other' AND state = 'S2'"


def _days(a: str, b: str) -> str:
    """Whole 24-hour days from a to b, rounded down."""
    return f"CAST(floor((epoch({b}) - epoch({a})) / 86400) AS BIGINT)"


def _subscribers(lake):
    return staging(lake, "customers").where("gender = 'Other' and state = 'S2'").select("customer_id")


@query("br1_update_customer_segments", f"""SELECT customer_id, seg AS customer_segment,
CASE WHEN seg IS DISTINCT FROM customer_segment THEN {_NOW} ELSE updated_at END AS updated_at
FROM (SELECT c.*, CASE WHEN c.customer_id IN ({_SUBSCRIBERS}) THEN 'VIP'
        WHEN {_days('signup_date', _NOW)} < 60 OR coalesce(n, 0) < 2 THEN 'New' WHEN coalesce(spend, 0) > 6000 THEN 'VIP' ELSE 'Regular' END AS seg
      FROM stg_customers c LEFT JOIN (SELECT customer_id, count(*) AS n,
             sum(CASE WHEN order_date >= {_NOW} - INTERVAL 180 DAY THEN total_amount END) AS spend FROM stg_orders GROUP BY 1) o
        ON c.customer_id = o.customer_id)""")
def _(lake):
    updated = rules.update_customer_segments(staging(lake, "customers"), staging(lake, "orders"), _subscribers(lake), as_of())
    return updated.select("customer_id", "customer_segment", "updated_at")


@query("br2_segment_at_order", f"""SELECT order_id, customer_id, previous_orders, CAST(recent_spend AS DOUBLE) AS recent_spend,
CASE WHEN customer_id IN ({_SUBSCRIBERS}) THEN 'VIP' WHEN {_days('signup_date', 'order_date')} < 60 OR previous_orders < 2 THEN 'New'
     WHEN recent_spend > 6000 THEN 'VIP' ELSE 'Regular' END AS segment
FROM (SELECT o.order_id, o.customer_id, o.order_date, c.signup_date, count(q.order_id) AS previous_orders,
        coalesce(sum(CASE WHEN q.order_date >= o.order_date - INTERVAL 180 DAY THEN q.total_amount END), 0) AS recent_spend
      FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id
      LEFT JOIN stg_orders q ON q.customer_id = o.customer_id AND (q.order_date, q.order_id) < (o.order_date, o.order_id)
      GROUP BY 1, 2, 3, 4)""")
def _(lake):
    return rules.segment_at_order(staging(lake, "orders"), staging(lake, "customers"), _subscribers(lake))


@query("br3_progress_orders", f"""SELECT order_id,
CASE WHEN ships THEN 'shipped' WHEN arrives THEN 'delivered' WHEN refunds THEN 'refunded' ELSE order_status END AS order_status,
CASE WHEN refunds THEN 'refunded' ELSE payment_status END AS payment_status,
CASE WHEN ships AND shipment_date IS NULL THEN order_date + INTERVAL 1 DAY ELSE shipment_date END AS shipment_date,
CASE WHEN arrives AND delivered_date IS NULL THEN order_date + INTERVAL 9 DAY ELSE delivered_date END AS delivered_date,
CASE WHEN ships OR arrives OR refunds THEN {_NOW} ELSE updated_at END AS updated_at
FROM (SELECT *, order_status = 'processing' AND {_days('order_date', _NOW)} >= 1 AS ships,
        order_status = 'shipped' AND {_days('order_date', _NOW)} >= 9 AS arrives,
        order_status = 'delivered' AND payment_status = 'completed' AND coalesce(delivered_date IS NOT NULL AND {_days('delivered_date', _NOW)} >= 5, false)
          AND order_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) AS refunds
      FROM stg_orders)""")
def _(lake):
    refunded = (lake.table("lineitem").where("l_returnflag = 'R' and l_quantity > 45")
                .select(c("l_orderkey").alias("order_id")))
    return rules.progress_orders(staging(lake, "orders"), as_of(), refunded).select(
        "order_id", "order_status", "payment_status", "shipment_date", "delivered_date", "updated_at")


_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@query("br4_derive_payments", f"""SELECT payment_id AS "payment-id", order_id AS "order-id", customer_id AS "customer-id", payment_method AS "payment-method",
CAST(total_amount AS DOUBLE) AS amount, payment_status AS "payment-status", {_TS.format('coalesce(payment_date, order_date)')} AS "payment-date",
{_TS.format('coalesce(payment_date, order_date)')} AS "created-at",
CASE WHEN payment_status = 'refunded' AND delivered_date IS NOT NULL THEN {_TS.format('delivered_date')}
     ELSE {_TS.format('coalesce(payment_date, order_date)')} END AS "updated-at"
FROM stg_orders WHERE payment_id IS NOT NULL""")
def _(lake):
    return rules.derive_payments(staging(lake, "orders"))


_SERVED = "('United States','Canada','United Kingdom','Germany','France','Italy','Spain','Japan','Netherlands','Australia')"


@query("br5_derive_shipments", f"""SELECT CAST(o.tracking_number AS BIGINT) AS tracking_number,
CASE WHEN o.shipping_carrier = 'UPS' THEN '1Z' || h WHEN o.shipping_carrier IN ('FedEx','USPS') THEN h[1:4] || ' ' || h[5:8] || ' ' || h[9:12] ELSE h END AS tracking_code,
o.order_id, o.shipping_carrier,
CASE WHEN c.country IN {_SERVED} THEN c.country ELSE 'United States' END AS origin_country,
CASE WHEN c.customer_id IS NULL THEN 'United States' ELSE c.country END AS destination_country,
CASE WHEN c.customer_id IS NULL THEN '00000' ELSE c.postal_code END AS destination_postal_code,
CASE WHEN o.delivered_date IS NOT NULL THEN 'delivered' WHEN o.shipment_date IS NOT NULL THEN 'in_transit' ELSE 'pending' END AS status,
CAST(o.shipping_cost AS DOUBLE) AS shipping_cost, {_TS.format('o.shipment_date')} AS "shipment-date",
{_TS.format('o.shipment_date + INTERVAL 5 DAY')} AS "estimated-delivery-date", {_TS.format('o.delivered_date')} AS "actual-delivery-date",
{_TS.format('o.shipment_date')} AS "created-at", {_TS.format('coalesce(o.delivered_date, o.shipment_date)')} AS "updated-at"
FROM (SELECT *, upper(md5(shipping_carrier || '|' || tracking_number)[1:12]) AS h FROM stg_orders WHERE tracking_number IS NOT NULL) o
LEFT JOIN stg_customers c ON o.customer_id = c.customer_id""")
def _(lake):
    return rules.derive_shipments(staging(lake, "orders"), staging(lake, "customers"))


@query("br6_overdue_band", f"""SELECT tracking_number, CASE WHEN shipment_date IS NOT NULL AND actual_delivery_date IS NULL THEN
CASE WHEN late > 7 THEN 'over_7_days' WHEN late > 4 THEN 'over_4_days' WHEN late > 2 THEN 'over_2_days' ELSE 'on_time' END END AS band
FROM (SELECT *, {_days('shipment_date + INTERVAL 5 DAY', _NOW)} AS late FROM stg_shipments)""")
def _(lake):
    return staging(lake, "shipments").select(
        "tracking_number", rules.overdue_band(c("shipment_date"), c("actual_delivery_date"), as_of()).alias("band"))


_PRICED = """SELECT i.order_id, s.subtotal, o.customer_segment, o.country, o.shipping_cost FROM
(SELECT order_id, CAST(sum(line_total) AS DECIMAL(18,2)) AS subtotal FROM bronze_order_items GROUP BY 1) s
JOIN (SELECT DISTINCT order_id FROM bronze_order_items) i ON i.order_id = s.order_id
JOIN (SELECT order_id, o.shipping_cost, c.customer_segment, c.country FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id) o ON o.order_id = s.order_id"""


@query("br7_price_orders", f"""SELECT order_id, CAST(subtotal AS DOUBLE) AS subtotal, CAST(discount AS DOUBLE) AS discount_amount, CAST(tax AS DOUBLE) AS tax_amount,
CAST(subtotal - discount + tax + shipping_cost AS DOUBLE) AS total_amount
FROM (SELECT *, CAST(round((subtotal - discount) * CASE country WHEN 'United States' THEN CAST('0.08' AS DECIMAL(3,2)) WHEN 'Canada' THEN CAST('0.13' AS DECIMAL(3,2))
        WHEN 'United Kingdom' THEN CAST('0.20' AS DECIMAL(3,2)) WHEN 'Germany' THEN CAST('0.19' AS DECIMAL(3,2)) WHEN 'France' THEN CAST('0.20' AS DECIMAL(3,2))
        WHEN 'Italy' THEN CAST('0.22' AS DECIMAL(3,2)) WHEN 'Spain' THEN CAST('0.21' AS DECIMAL(3,2)) WHEN 'Japan' THEN CAST('0.10' AS DECIMAL(3,2))
        WHEN 'Netherlands' THEN CAST('0.21' AS DECIMAL(3,2)) WHEN 'Australia' THEN CAST('0.10' AS DECIMAL(3,2)) END, 2) AS DECIMAL(18,2)) AS tax
      FROM (SELECT *, CAST(CASE WHEN shipping_cost < 12 THEN round(subtotal * CASE customer_segment WHEN 'Regular' THEN CAST('0.05' AS DECIMAL(3,2)) ELSE CAST('0.10' AS DECIMAL(3,2)) END, 2) ELSE 0 END AS DECIMAL(18,2)) AS discount
            FROM ({_PRICED})))""")
def _(lake):
    who = staging(lake, "customers").select("customer_id", c("customer_segment").alias("segment"), "country")
    per_order = (aggregates.order_subtotals(lake.bronze("order_items")).select("order_id", c("subtotal").cast("decimal(18,2)").alias("subtotal"))
                 .join(staging(lake, "orders").select("order_id", "customer_id", "shipping_cost"), "order_id")
                 .join(who, "customer_id"))
    return rules.price_orders(per_order, c("shipping_cost") < 12).select(
        "order_id", "subtotal", "discount_amount", "tax_amount", "total_amount")


@query("br8_free_shipping", """SELECT order_id, ordinal, threshold, CAST(subtotal AS DOUBLE) >= threshold AS ships_free
FROM (SELECT *, CASE WHEN customer_segment = 'VIP' THEN 20 WHEN customer_segment = 'New' AND ordinal = 1 THEN 0 WHEN customer_segment = 'New' AND ordinal = 2 THEN 40 ELSE 50 END AS threshold
      FROM (SELECT o.order_id, o.subtotal, c.customer_segment, row_number() OVER (PARTITION BY o.customer_id ORDER BY o.order_date, o.order_id) AS ordinal
            FROM stg_orders o JOIN stg_customers c ON o.customer_id = c.customer_id))""")
def _(lake):
    orders = staging(lake, "orders").select("order_id", "customer_id", "order_date", "subtotal")
    numbered = ordered.row_numbers(orders, [c("order_date").asc(), c("order_id").asc()], "ordinal", ["customer_id"])
    df = numbered.join(staging(lake, "customers").select("customer_id", "customer_segment"), "customer_id")
    threshold = rules.free_shipping_threshold(c("customer_segment"), c("ordinal"))
    return df.select("order_id", "ordinal", threshold.alias("threshold"), (c("subtotal") >= threshold).alias("ships_free"))


@query("br9_orders_to_derive", "SELECT order_id, order_status FROM bronze_orders WHERE load_type = 'incremental' OR order_date >= TIMESTAMP '2001-01-01'")
def _(lake):
    o = lake.bronze("orders")
    updated = o.where("load_type = 'incremental'")
    new = o.where("load_type <> 'incremental' and order_date >= timestamp '2001-01-01'")
    return rules.orders_to_derive(new, updated).select("order_id", "order_status")


@query("br10_status_band", f"""SELECT order_id, CASE WHEN payment_status = 'failed' THEN 'cancelled' WHEN payment_status = 'pending' THEN 'pending'
WHEN age > 9 THEN 'delivered|refunded' WHEN age > 4 THEN 'shipped|delivered' WHEN age > 1 THEN 'processing|shipped' ELSE 'processing' END AS band
FROM (SELECT *, {_days('order_date', _NOW)} AS age FROM stg_orders)""")
def _(lake):
    return staging(lake, "orders").select("order_id", rules.status_band(c("order_date"), c("payment_status"), as_of()).alias("band"))
