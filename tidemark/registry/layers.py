"""Silver and gold tables as named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import width_of
from tidemark.plans import gold, silver
from tidemark.registry.core import as_of, query
from tidemark.session import scratch_path, settled, stage
from tidemark.sinks import colocated
from tidemark.sources.bronze import Lake


def staging(lake: Lake, entity: str) -> DataFrame:
    bronze = lake.bronze(entity)
    return silver.stg_customers(bronze, as_of()) if entity == "customers" else silver.STAGING[entity](bronze)


def facts(lake: Lake) -> DataFrame:
    return gold.order_facts(staging(lake, "orders"), staging(lake, "payments"), staging(lake, "shipments"))


def profiles(lake: Lake) -> DataFrame:
    return gold.customer_360(staging(lake, "customers"), facts(lake), as_of())


@query("stg1_stg_customers", "SELECT * FROM stg_customers")
def _(lake):
    return staging(lake, "customers")


_ORDER_MONEY = """* REPLACE (CAST(subtotal AS DOUBLE) AS subtotal, CAST(discount_amount AS DOUBLE) AS discount_amount,
CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(shipping_cost AS DOUBLE) AS shipping_cost, CAST(total_amount AS DOUBLE) AS total_amount"""


@query("stg2_stg_orders", f"SELECT {_ORDER_MONEY}) FROM stg_orders")
def _(lake):
    return staging(lake, "orders")


@query("stg3_stg_payments", "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM stg_payments")
def _(lake):
    return staging(lake, "payments")


@query("stg4_stg_products",
       "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost) FROM stg_products")
def _(lake):
    return staging(lake, "products")


@query("stg5_stg_shipments", "SELECT * REPLACE (CAST(shipping_cost AS DOUBLE) AS shipping_cost) FROM stg_shipments")
def _(lake):
    return staging(lake, "shipments")


@query("gld1_order_facts", f"SELECT {_ORDER_MONEY}, CAST(payment_amount AS DOUBLE) AS payment_amount) FROM order_facts")
def _(lake):
    return facts(lake)


LEAST_BUCKETS = 8


def colocated_facts(lake, buckets: int | None = None) -> DataFrame:
    """The facts over silver tables dealt by order, into buckets for the largest of them unless told how many."""
    own = []
    if buckets is None:
        widths = {e: sum(width_of(f.dataType) for f in staging(lake, e).schema.fields) for e in ("orders", "payments", "shipments")}
        buckets = max(LEAST_BUCKETS, colocated.buckets_for(max(lake.bronze(e).count() * w for e, w in widths.items())))
    for entity in ("orders", "payments", "shipments"):
        path = scratch_path(lake.spark, f"colocated-{entity}")
        own.append(colocated.write_colocated(staging(lake, entity), "tidemark_" + path.rsplit("-", 1)[1], "order_id", buckets, path))
    return gold.order_facts(*own)


@query("gld1_colocated_order_facts", f"SELECT {_ORDER_MONEY}, CAST(payment_amount AS DOUBLE) AS payment_amount) FROM order_facts")
def _(lake):
    return colocated_facts(lake)


_DAILY = """SELECT total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
paid_orders, delivered_orders, CAST(refund_amounts AS DOUBLE) AS refund_amounts, day FROM daily_metrics"""


@query("gld2_daily_metrics", _DAILY)
def _(lake):
    return gold.daily_metrics(facts(lake))


@query("gld2_daily_metrics_last_days", _DAILY + " WHERE day >= DATE '2001-08-02' - 7")
def _(lake):
    return gold.daily_metrics(gold.recent_days(facts(lake), as_of()))


_DISTINCT = """SELECT {0}, count(DISTINCT order_id) AS total_orders,
count(DISTINCT CASE WHEN payment_status IN ('completed', 'success') THEN order_id END) AS paid_orders,
count(DISTINCT CASE WHEN shipment_status = 'delivered' OR actual_delivery_date IS NOT NULL THEN order_id END) AS delivered_orders
FROM order_facts WHERE order_date IS NOT NULL GROUP BY 1"""


def _staged_facts(lake):
    """What the sets read of the facts, built once for all batches."""
    return stage(facts(lake).select("order_id", "order_date", "payment_status", "shipment_status", "actual_delivery_date"), "facts")


def _sets_of_two_batches(own):
    """Sets of two batches, the second of which delivers most orders of the first again."""
    return gold.daily_order_sets(own.where("order_id % 3 <> 0")).unionByName(gold.daily_order_sets(own.where("order_id % 5 <> 1")))


@query("gld2_daily_distinct_orders", _DISTINCT.format("CAST(order_date AS DATE) AS day"))
def _(lake):
    def counted():
        own = _staged_facts(lake)
        return gold.distinct_orders(gold.merged_order_sets(_sets_of_two_batches(own).unionByName(gold.daily_order_sets(own)), F.col("day")), "day")
    return settled(lake.spark, counted, "distinct-orders")


@query("gld2_monthly_distinct_orders", _DISTINCT.format("CAST(date_trunc('month', order_date) AS DATE) AS month").replace("GROUP BY 1", "AND (order_id % 3 <> 0 OR order_id % 5 <> 1) GROUP BY 1"))
def _(lake):
    def counted():
        days = gold.merged_order_sets(_sets_of_two_batches(_staged_facts(lake)), F.col("day"))
        return gold.distinct_orders(gold.merged_order_sets(days, F.to_date(F.date_trunc("month", "day")).alias("month")), "month")
    return settled(lake.spark, counted, "distinct-orders")


@query("gld3_customer_360", """SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue,
CAST(avg_order_value AS DOUBLE) AS avg_order_value) FROM customer_360""")
def _(lake):
    return profiles(lake)


@query("gld4_rfm_scores", "SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM rfm_scores")
def _(lake):
    # the quintiles read their input several times
    return settled(lake.spark, lambda: gold.rfm_scores(stage(profiles(lake), "profiles")), "rfm-scores")


@query("gld5_product_catalog", """SELECT product_id, product_name, category, sub_category, brand, CAST(price AS DOUBLE) AS price,
CAST(cost AS DOUBLE) AS cost, created_at, color FROM stg_products""")
def _(lake):
    return gold.product_catalog(staging(lake, "products"))


@query("gld6_landed_rows", " UNION ALL ".join(
    f"SELECT ingestion_date, load_type, '{e}' AS entity, count(*) AS row_count FROM bronze_{e} GROUP BY 1, 2"
    for e in ("customers", "orders", "payments", "products", "shipments")))
def _(lake):
    return gold.landed_rows({e: lake.bronze(e) for e in ("customers", "orders", "payments", "products", "shipments")})


@query("gld7_recent_runs", """SELECT CAST(order_date AS DATE) AS run_date, count(*) AS records FROM bronze_orders
WHERE CAST(order_date AS DATE) > DATE '2001-08-02' - 7 GROUP BY 1""")
def _(lake):
    runs = lake.bronze("orders").groupBy(F.to_date("order_date").alias("run_date")).agg(F.count(F.lit(1)).alias("records"))
    return gold.recent_runs(runs, "run_date", as_of())
