"""Data-quality checks over the given tables and the declared suite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.plans import gold
from tidemark.registry.core import as_of, query
from tidemark.registry.layers import staging
from tidemark.session import settled, stage

c = F.col


@query("dq1_not_null", "SELECT customer_id, email FROM stg_customers WHERE email IS NULL")
def _(lake):
    return checks.not_null(staging(lake, "customers"), "email").select("customer_id", "email")


@query("dq2_unique", 'SELECT "payment-id" AS unique_field, count(*) AS n_records FROM bronze_payments GROUP BY 1 HAVING count(*) > 1')
def _(lake):
    return checks.unique(lake.bronze("payments"), "payment-id")


@query("dq3_accepted_values", """SELECT status AS value_field, count(*) AS n_records FROM stg_shipments GROUP BY 1
HAVING status NOT IN ('pending','in_transit','delivered','returned','cancelled','exception')""")
def _(lake):
    return checks.accepted_values(staging(lake, "shipments"), "status", checks.SHIPMENT_STATUSES)


@query("dq4_relationships", "SELECT order_id AS from_field FROM stg_payments p WHERE order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id)")
def _(lake):
    return checks.relationships(staging(lake, "payments"), "order_id", staging(lake, "orders"), "order_id")


@query("dq4_relationships_counted", "SELECT count(*) AS failures FROM stg_payments p WHERE order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id)")
def _(lake):
    return checks.orphan_count(staging(lake, "payments"), "order_id", staging(lake, "orders"), "order_id")


@query("dq5_relationships_where", """SELECT order_id AS from_field FROM stg_payments p WHERE payment_status <> 'failed' AND order_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE NOT is_cancelled AND o.order_id = p.order_id)""")
def _(lake):
    return checks.relationships_where(staging(lake, "payments"), "order_id", staging(lake, "orders"), "order_id",
                                      "payment_status <> 'failed'", "not is_cancelled")


@query("dq6_expression_is_true", "SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount FROM stg_orders WHERE NOT (total_amount >= 0)")
def _(lake):
    return checks.expression_is_true(staging(lake, "orders"), ">= 0", "total_amount").select("order_id", "total_amount")


@query("dq6_expression_with_condition", "SELECT order_id FROM stg_orders WHERE is_delivered AND NOT (delivered_date >= order_date + INTERVAL 10 DAY)")
def _(lake):
    return checks.expression_is_true(staging(lake, "orders"), "delivered_date >= order_date + interval 10 days",
                                     condition="is_delivered").select("order_id")


@query("dq7_accepted_range", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND (l_quantity <= 2 OR l_quantity >= 49)")
def _(lake):
    return checks.accepted_range(lake.table("lineitem"), "l_quantity", 2, 49, inclusive=False,
                                 where="l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


def _tagged(checked) -> DataFrame:
    """The failures of several columns with the column's name."""
    return reduce(DataFrame.unionAll, [found.select(F.lit(name).alias("column_name"), "*") for name, found in checked])


_KINDS = ["click", "error", "refund", "signup"]


@query("dq8_at_least_one", " UNION ALL ".join(
    f"SELECT '{k}' AS column_name, count(CASE WHEN event_type = '{k}' THEN value END) AS filled FROM events HAVING count(CASE WHEN event_type = '{k}' THEN value END) = 0"
    for k in _KINDS))
def _(lake):
    """Some kinds occur, others do not."""
    e = lake.table("events").withColumns({k: F.when(c("event_type") == k, c("value")) for k in _KINDS})
    return _tagged([(k, checks.at_least_one(e, k)) for k in _KINDS])


_MAYBE_CONSTANT = ["_source_system", "payment-method", "load_type", "card-brand"]


@query("dq9_not_constant", " UNION ALL ".join(
    f"""SELECT '{n}' AS column_name, count(DISTINCT "{n}") AS distinct_values FROM bronze_payments HAVING count(DISTINCT "{n}") = 1""" for n in _MAYBE_CONSTANT))
def _(lake):
    """One column is the same throughout, the others are not."""
    p = lake.bronze("payments")
    return _tagged([(n, checks.not_constant(p, n)) for n in _MAYBE_CONSTANT])


@query("dq10_not_null_proportion", "SELECT avg(CASE WHEN email IS NULL THEN 0.0 ELSE 1 END) AS not_null_proportion FROM stg_customers HAVING NOT (avg(CASE WHEN email IS NULL THEN 0.0 ELSE 1 END) BETWEEN 0.95 AND 1)")
def _(lake):
    return checks.not_null_proportion(staging(lake, "customers"), "email", 0.95)


@query("dq11_not_accepted_values", "SELECT DISTINCT order_status AS value_field FROM stg_orders WHERE order_status IN ('refunded', 'cancelled', 'lost')")
def _(lake):
    return checks.not_accepted_values(staging(lake, "orders"), "order_status", ["refunded", "cancelled", "lost"])


@query("dq12_unique_combination", "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(lake):
    return checks.unique_combination(lake.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq13_cardinality_equality", """WITH a AS (SELECT c_nationkey AS value_field, count(*) AS num_rows FROM customer GROUP BY 1),
b AS (SELECT s_nationkey AS value_field, count(*) AS num_rows FROM supplier GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(lake):
    return checks.cardinality_equality(lake.table("customer"), "c_nationkey", lake.table("supplier"), "s_nationkey")


_VERSIONS = ("SELECT order_id, lower(order_status) AS order_status FROM bronze_orders WHERE load_type = 'full'",
             "SELECT order_id, order_status FROM stg_orders")


def _versions(lake):
    first = lake.bronze("orders").where("load_type = 'full'").select("order_id", F.lower("order_status").alias("order_status"))
    return first, staging(lake, "orders")


_EQUALITY = f"""SELECT 'a_minus_b' AS which_diff, * FROM ({_VERSIONS[0]} EXCEPT {_VERSIONS[1]})
UNION ALL SELECT 'b_minus_a', * FROM ({_VERSIONS[1]} EXCEPT {_VERSIONS[0]})"""


@query("dq14_equality", _EQUALITY)
def _(lake):
    first, latest = _versions(lake)
    return checks.equality(first, latest, ["order_id", "order_status"])


@query("dq14_equality_failures", f"""SELECT count(*) + abs(count(*) FILTER (WHERE which_diff = 'a_minus_b') - count(*) FILTER (WHERE which_diff = 'b_minus_a')) AS failures
FROM ({_EQUALITY})""")
def _(lake):
    first, latest = _versions(lake)
    return checks.equality_failures(checks.equality(first, latest, ["order_id", "order_status"]))


@query("dq15_equal_rowcount", """SELECT (SELECT count(*) FROM bronze_payments) AS count_a, (SELECT count(*) FROM stg_payments) AS count_b,
abs((SELECT count(*) FROM bronze_payments) - (SELECT count(*) FROM stg_payments)) AS diff_count""")
def _(lake):
    return checks.equal_rowcount(lake.bronze("payments"), staging(lake, "payments"))


@query("dq16_fewer_rows_than", """SELECT a AS count_a, b AS count_b, CAST(CASE WHEN a > b THEN a - b WHEN a = b THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM orders) AS b)""")
def _(lake):
    return checks.fewer_rows_than(lake.table("lineitem"), lake.table("orders"))


@query("dq17_recency", "SELECT max(ts) AS most_recent FROM events HAVING max(ts) < TIMESTAMP '2024-02-05' - INTERVAL 5 DAY")
def _(lake):
    return checks.recency(lake.table("events"), "ts", "day", 5, F.lit("2024-02-05").cast("timestamp"))


@query("dq18_sequential_values", """SELECT value, previous_value FROM (SELECT o_custkey AS value, lag(o_custkey) OVER (ORDER BY o_custkey) AS previous_value FROM orders)
WHERE NOT (value = previous_value + 1)""")
def _(lake):
    return checks.sequential_values(lake.table("orders"), "o_custkey")


@query("dq18_sequential_days", """SELECT value, previous_value FROM (SELECT o_orderdate AS value, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS previous_value FROM orders)
WHERE NOT (value = previous_value + INTERVAL 1 DAY)""")
def _(lake):
    return checks.sequential_values(lake.table("orders"), "o_orderdate", 1, "day")


def _ranges_sql(op: str, zero: str) -> str:
    return f"""SELECT *, coalesce(lower_bound {zero} upper_bound, false) AS lower_before_upper,
  coalesce(upper_bound {op} next_lower_bound, is_last_record) AS upper_before_next
FROM (SELECT o_custkey, o_orderdate AS lower_bound, o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS upper_bound,
        lead(o_orderdate) OVER w AS next_lower_bound, lead(o_orderdate) OVER w IS NULL AS is_last_record
      FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER))))
WHERE NOT (lower_before_upper AND upper_before_next)"""


def _ranges(lake):
    return lake.table("orders").select("o_custkey", "o_orderdate", F.timestamp_add(
        "DAY", (c("o_orderkey") % 40).cast("int"), c("o_orderdate")).alias("until"))


@query("dq19_ranges_gaps_allowed", _ranges_sql("<=", "<"))
def _(lake):
    return checks.mutually_exclusive_ranges(_ranges(lake), "o_orderdate", "until", "o_custkey")


@query("dq19_ranges_no_gaps", _ranges_sql("=", "<="))
def _(lake):
    return checks.mutually_exclusive_ranges(_ranges(lake), "o_orderdate", "until", "o_custkey", "not_allowed", True)


@query("dq19_ranges_gaps_required", _ranges_sql("<", "<"))
def _(lake):
    return checks.mutually_exclusive_ranges(_ranges(lake), "o_orderdate", "until", "o_custkey", "required")


@query("dq20_not_null_where", "SELECT customer_id FROM stg_customers WHERE customer_segment = 'New' AND phone IS NULL")
def _(lake):
    return checks.not_null(staging(lake, "customers"), "phone", where="customer_segment = 'New'").select("customer_id")


@query("dq20_unique_where", "SELECT order_id AS unique_field, count(*) AS n_records FROM bronze_orders WHERE customer_id >= 0 GROUP BY 1 HAVING count(*) > 1")
def _(lake):
    return checks.unique(lake.bronze("orders"), "order_id", where="customer_id >= 0")


def _suite_sql() -> str:
    parts = []

    def add(model: str, test: str, failing: str, severity: str = "error") -> None:
        parts.append(f"SELECT '{model}' AS model, '{test}' AS test, count(*) AS failures, '{severity}' AS severity FROM ({failing})")
    tables = {**checks.KEYS}
    source = {"product_catalog": "stg_products"}
    for model, key in tables.items():
        t = source.get(model, model)
        add(model, f"not_null_{key}", f"SELECT 1 FROM {t} WHERE {key} IS NULL")
        add(model, f"unique_{key}", f"SELECT {key} FROM {t} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
    for model, col in (("stg_customers", "email"), ("stg_orders", "customer_id"), ("stg_payments", "order_id"),
                       ("stg_shipments", "order_id"), ("order_facts", "customer_id")):
        add(model, f"not_null_{col}", f"SELECT 1 FROM {model} WHERE {col} IS NULL")
    for model, col, values in (("stg_orders", "order_status", checks.ORDER_STATUSES), ("stg_orders", "payment_status", checks.PAYMENT_STATUSES),
                               ("stg_payments", "payment_status", checks.PAYMENT_STATUSES), ("stg_shipments", "status", checks.SHIPMENT_STATUSES)):
        listed = ", ".join(f"'{v}'" for v in values)
        add(model, f"accepted_values_{col}", f"SELECT {col} FROM {model} GROUP BY 1 HAVING {col} NOT IN ({listed})")
    for model, col, parent in (("stg_orders", "customer_id", "stg_customers"), ("stg_payments", "order_id", "stg_orders"),
                               ("stg_shipments", "order_id", "stg_orders")):
        add(model, f"relationships_{col}", f"SELECT 1 FROM {model} m WHERE {col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{col} = m.{col})")
    add("order_facts", "expression_total_amount", "SELECT 1 FROM order_facts WHERE NOT (total_amount >= 0)", "warn")
    return ("SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ("
            + " UNION ALL ".join(parts) + ")")


#: What the checks and the models built on a model read of it; of models not listed everything is written.
_READ = {
    "stg_orders": ["order_id", "customer_id", "order_date", "payment_date", "order_status", "payment_status", "subtotal", "discount_amount", "tax_amount", "shipping_cost",
                   "total_amount", "payment_method", "shipping_carrier", "tracking_number", "_ingestion_ts"],
    "stg_payments": ["payment_id", "order_id", "payment_status", "payment_date", "amount"],
    "stg_shipments": ["tracking_number", "order_id", "status", "shipping_carrier", "shipment_date", "estimated_delivery_date", "actual_delivery_date", "created_at"],
    "order_facts": ["order_id", "customer_id", "order_date", "payment_status", "payment_method", "shipment_status", "shipping_carrier", "actual_delivery_date", "total_amount"],
}


@query("dq21_declared_suite", _suite_sql())
def _(lake):
    def model(name: str, df: DataFrame) -> DataFrame:
        return stage(df.select(*_READ.get(name, df.columns)), name)

    def checked() -> DataFrame:
        # every model is written once, as in production, in the columns that are read of it
        t = {f"stg_{e}": model(f"stg_{e}", staging(lake, e)) for e in ("customers", "orders", "payments", "products", "shipments")}
        t["order_facts"] = model("order_facts", gold.order_facts(t["stg_orders"], t["stg_payments"], t["stg_shipments"]))
        t["daily_metrics"] = stage(gold.daily_metrics(t["order_facts"]), "daily_metrics")
        t["customer_360"] = stage(gold.customer_360(t["stg_customers"], t["order_facts"], as_of()), "customer_360")
        t["rfm_scores"] = stage(gold.rfm_scores(t["customer_360"]), "rfm_scores")
        t["product_catalog"] = gold.product_catalog(t["stg_products"])
        return checks.run_checks(t, checks.declared_suite())
    return settled(lake.spark, checked, "suite")


@query("dq22_assert_equal", "SELECT order_id, order_status, payment_status FROM stg_orders WHERE order_status <> payment_status")
def _(lake):
    return checks.assert_equal(staging(lake, "orders"), "order_status", "payment_status").select("order_id", "order_status", "payment_status")


@query("dq22_not_empty_string", "SELECT customer_id FROM (SELECT customer_id, trim(phone) AS phone FROM bronze_customers) WHERE phone = ''")
def _(lake):
    return checks.not_empty_string(lake.bronze("customers").select("customer_id", F.trim("phone").alias("phone")), "phone").select("customer_id")
