"""Filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import aggregates, checks, dedupe, filters, history, joins, ordered, paging, reshape
from tidemark.plans import gold, rules
from tidemark.registry.core import as_of, query
from tidemark.registry.layers import facts, profiles, staging

c = F.col


# -- filters -----------------------------------------------------------------------------------------

@query("flt1_high_watermark", """SELECT order_id, _ingestion_ts FROM bronze_orders
WHERE _ingestion_ts > (SELECT max(_ingestion_ts) FROM bronze_orders WHERE load_type = 'full' AND order_status = 'DELIVERED' AND order_date < TIMESTAMP '2000-01-01')""")
def _(lake):
    source = lake.bronze("orders")
    target = source.where("load_type = 'full' and order_status = 'DELIVERED' and order_date < timestamp '2000-01-01'")
    return filters.newer_than(source, target).select("order_id", "_ingestion_ts")


@query("flt2_late_data_window", "SELECT order_id, order_date FROM bronze_orders WHERE CAST(order_date AS DATE) >= DATE '2001-08-02' - 7")
def _(lake):
    return gold.recent_days(lake.bronze("orders"), as_of()).select("order_id", "order_date")


@query("flt3_has_text", "SELECT customer_id, phone, (phone IS NOT NULL AND trim(phone) <> '') AS has_phone FROM bronze_customers WHERE email IS NOT NULL AND trim(email) <> ''")
def _(lake):
    return (lake.bronze("customers").where(filters.has_text(c("email")))
            .select("customer_id", "phone", filters.has_text(c("phone")).alias("has_phone")))


@query("flt4_in_not_in", """SELECT order_id, lower(order_status) AS order_status, lower(order_status) NOT IN ('cancelled','refunded') AS is_open
FROM bronze_orders WHERE lower(payment_status) IN ('completed','success','refunded')""")
def _(lake):
    o = lake.bronze("orders").where(F.lower("payment_status").isin("completed", "success", "refunded"))
    return filters.split_open_orders(o).select("order_id", F.lower("order_status").alias("order_status"), "is_open")


@query("flt5_email_pattern", "SELECT customer_id, email FROM stg_customers WHERE is_valid_email")
def _(lake):
    return staging(lake, "customers").where("is_valid_email").select("customer_id", "email")


@query("flt6_rank_filter", """SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def _(lake):
    return dedupe.first_per_key(lake.table("orders"), ["o_custkey"],
                                [c("o_totalprice").desc(), c("o_orderkey").asc()]).select("o_custkey", "o_orderkey")


@query("flt7_active_customers", "SELECT customer_id, total_orders FROM customer_360 WHERE total_orders > 0 AND days_since_last_order IS NOT NULL")
def _(lake):
    return (profiles(lake).where("total_orders > 0 and days_since_last_order is not null")
            .select("customer_id", "total_orders"))


@query("flt8_having", """SELECT "payment-id" AS payment_id, count(*) AS n, count("payment-date") AS dated,
count(DISTINCT "payment-status") AS statuses FROM bronze_payments GROUP BY 1
HAVING count(*) > 1 AND (count("payment-date") = 0 OR count(DISTINCT "payment-status") = 1)""")
def _(lake):
    p = lake.bronze("payments")
    grouped = p.groupBy(c("`payment-id`").alias("payment_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count(c("`payment-date`")).alias("dated"),
        F.count_distinct(c("`payment-status`")).alias("statuses"))
    return grouped.where("n > 1 and (dated = 0 or statuses = 1)")


@query("flt9_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' AND p_brand NOT ILIKE 'brand#1_'")
def _(lake):
    return (lake.table("part").where(c("p_name").ilike("%RING%") & ~c("p_brand").ilike("brand#1_"))
            .select("p_partkey", "p_name"))


# -- joins -------------------------------------------------------------------------------------------

@query("jn1_orders_payments_shipments", """SELECT o.order_id, p.payment_id, s.tracking_number FROM stg_orders o
LEFT JOIN (SELECT order_id, max(payment_id) AS payment_id FROM stg_payments GROUP BY 1) p ON o.order_id = p.order_id
LEFT JOIN (SELECT order_id, max(tracking_number) AS tracking_number FROM stg_shipments GROUP BY 1) s ON o.order_id = s.order_id""")
def _(lake):
    p = staging(lake, "payments").groupBy("order_id").agg(F.max("payment_id").alias("payment_id"))
    s = staging(lake, "shipments").groupBy("order_id").agg(F.max("tracking_number").alias("tracking_number"))
    return (staging(lake, "orders").select("order_id").join(p, "order_id", "left").join(s, "order_id", "left")
            .select("order_id", "payment_id", "tracking_number"))


@query("jn2_customers_aggregates", """SELECT c.customer_id, o.n_orders, o.last_order FROM stg_customers c
LEFT JOIN (SELECT customer_id, count(*) AS n_orders, max(order_date) AS last_order FROM stg_orders GROUP BY 1) o ON c.customer_id = o.customer_id""")
def _(lake):
    o = staging(lake, "orders").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"),
                                                           F.max("order_date").alias("last_order"))
    return (staging(lake, "customers").select("customer_id").join(o, "customer_id", "left")
            .select("customer_id", "n_orders", "last_order"))


@query("jn3_anti_join", """SELECT payment_id, order_id FROM stg_payments p
WHERE order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id)""")
def _(lake):
    return joins.without_parent(staging(lake, "payments"), "order_id", staging(lake, "orders"), "order_id").select(
        "payment_id", "order_id")


@query("jn4_row_counts_side_by_side", """SELECT (SELECT count(*) FROM bronze_orders) AS count_a, (SELECT count(*) FROM stg_orders) AS count_b,
(SELECT count(*) FROM bronze_orders) - (SELECT count(*) FROM stg_orders) AS diff_count""")
def _(lake):
    return checks.equal_rowcount(lake.bronze("orders"), staging(lake, "orders"))


@query("jn5_number_generator", "SELECT o_orderkey, unnest(range(1, o_custkey % 8 + 1)) AS generated_number FROM orders")
def _(lake):
    return reshape.series_per_row(lake.table("orders").select("o_orderkey", "o_custkey"), c("o_custkey") % 8).select(
        "o_orderkey", "generated_number")


@query("jn6_rank_instead_of_self_join", """SELECT order_id, _ingestion_ts, order_status FROM bronze_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts) = 1""")
def _(lake):
    return dedupe.first_per_key(lake.bronze("orders"), ["order_id"], [c("_ingestion_ts").asc()]).select(
        "order_id", "_ingestion_ts", "order_status")


@query("jn7_lookup_with_defaults", """SELECT o.order_id, CASE WHEN c.customer_id IS NULL THEN 'United States' ELSE c.country END AS destination_country,
CASE WHEN c.customer_id IS NULL THEN '00000' ELSE c.postal_code END AS destination_postal_code,
CASE WHEN c.country IN ('United States','Canada','United Kingdom','Germany','France','Italy','Spain','Japan','Netherlands','Australia')
     THEN c.country ELSE 'United States' END AS origin_country
FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id""")
def _(lake):
    return rules.with_destination(staging(lake, "orders"), staging(lake, "customers")).select(
        "order_id", "destination_country", "destination_postal_code", "origin_country")


_OLD_NEW = """(SELECT order_id, order_status, delivered_date FROM bronze_orders WHERE load_type = 'full') o
{join} (SELECT order_id, lower(order_status) AS order_status, delivered_date FROM bronze_orders WHERE load_type = 'incremental') n ON o.order_id = n.order_id"""


@query("jn8_update_by_key", "SELECT o.order_id, coalesce(n.order_status, o.order_status) AS order_status, coalesce(n.delivered_date, o.delivered_date) AS delivered_date FROM "
       + _OLD_NEW.format(join="LEFT JOIN"))
def _(lake):
    o = lake.bronze("orders").select("order_id", "order_status", "delivered_date", "load_type")
    old, new = o.where("load_type = 'full'"), o.where("load_type = 'incremental'")
    new = new.withColumn("order_status", F.lower("order_status"))
    return joins.update_by_key(old.drop("load_type"), new, "order_id", ["order_status", "delivered_date"])


@query("jn9_changed_count", "SELECT count(*) AS compared, count(*) FILTER (WHERE lower(o.order_status) IS DISTINCT FROM n.order_status) AS changed FROM "
       + _OLD_NEW.format(join="JOIN"))
def _(lake):
    o = lake.bronze("orders").withColumn("order_status", F.lower("order_status"))
    return joins.changed_count(o.where("load_type = 'full'"), o.where("load_type = 'incremental'"), "order_id", "order_status")


@query("jn10_products_available", """SELECT order_id, CASE WHEN n = 0 THEN (SELECT count(*) FROM stg_products) ELSE n END AS available
FROM (SELECT o.order_id, (SELECT count(*) FROM stg_products p WHERE p.created_at <= o.order_date) AS n FROM stg_orders o)""")
def _(lake):
    return joins.available_at(staging(lake, "orders"), staging(lake, "products"))


_A = "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"
_B = "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"


def _halves(lake) -> tuple[DataFrame, DataFrame]:
    o = lake.table("orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    early = c("o_orderdate") < F.lit("1998-01-01").cast("timestamp")
    return o.where(early).drop("o_orderdate"), o.where(~early).drop("o_orderdate")


@query("jn11_set_difference_both_ways", f"""SELECT 'a_minus_b' AS which_diff, * FROM ({_A} EXCEPT {_B})
UNION ALL SELECT 'b_minus_a', * FROM ({_B} EXCEPT {_A})""")
def _(lake):
    return joins.set_difference(*_halves(lake))


# -- aggregates --------------------------------------------------------------------------------------

@query("ag1_count", 'SELECT "payment-status" AS status, count(*) AS n_rows, count("payment-date") AS dated FROM bronze_payments GROUP BY 1')
def _(lake):
    return lake.bronze("payments").groupBy(c("`payment-status`").alias("status")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(c("`payment-date`")).alias("dated"))


@query("ag2_count_distinct", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def _(lake):
    return lake.table("lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("orders"),
                                                              F.count_distinct("l_suppkey").alias("suppliers"))


@query("ag3_conditional_distinct", """SELECT l_linestatus, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned_orders,
count(DISTINCT CASE WHEN l_quantity > 25 THEN l_partkey END) AS bulk_parts FROM lineitem GROUP BY 1""")
def _(lake):
    return lake.table("lineitem").groupBy("l_linestatus").agg(
        F.count_distinct(F.when(c("l_returnflag") == "R", c("l_orderkey"))).alias("returned_orders"),
        F.count_distinct(F.when(c("l_quantity") > 25, c("l_partkey"))).alias("bulk_parts"))


@query("ag4_sums", """SELECT customer_id, CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total,
CAST(coalesce(sum(CASE WHEN total_amount < 0 THEN total_amount ELSE 0 END), 0) AS DOUBLE) AS refunds FROM bronze_orders GROUP BY 1""")
def _(lake):
    t = c("total_amount")
    return lake.bronze("orders").groupBy("customer_id").agg(
        F.coalesce(F.sum(t), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(t < 0, t).otherwise(0)), F.lit(0)).alias("refunds"))


@query("ag5_guarded_ratio", """SELECT user_id, CASE WHEN count(*) FILTER (WHERE event_type = 'click') = 0 THEN 0
ELSE round(count(*) FILTER (WHERE event_type = 'purchase') * 1.0 / count(*) FILTER (WHERE event_type = 'click'), 6) END AS purchases_per_click FROM events GROUP BY 1""")
def _(lake):
    from tidemark.functions.numeric import ratio
    per_user = lake.table("events").groupBy("user_id").agg(F.count_if(c("event_type") == "purchase").alias("p"),
                                                           F.count_if(c("event_type") == "click").alias("k"))
    return per_user.select("user_id", F.round(ratio(c("p").cast("double"), c("k").cast("double")), 6).alias("purchases_per_click"))


@query("ag6_min_max", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1")
def _(lake):
    return lake.table("events").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


@query("ag7_two_keys", "SELECT customer_id, payment_method, count(*) AS method_count, max(order_date) AS latest_use FROM bronze_orders WHERE payment_method IS NOT NULL GROUP BY 1, 2")
def _(lake):
    return (lake.bronze("orders").where("payment_method is not null").groupBy("customer_id", "payment_method")
            .agg(F.count(F.lit(1)).alias("method_count"), F.max("order_date").alias("latest_use")))


@query("ag8_mode_latest_tie", """SELECT user_id, event_type, count(*) AS uses FROM events GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, max(ts) DESC, event_type DESC) = 1""")
def _(lake):
    return aggregates.mode_per_key(lake.table("events"), ["user_id"], "event_type", "ts")


@query("ag9_group_by_position", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(lake):
    e = lake.table("events").select(F.to_date("ts").alias("day"), "event_type", "value")
    return aggregates.group_by_first(e, 2).agg(F.count(F.lit(1)).alias("n"))


@query("ag10_any_value", "SELECT n_regionkey, n_regionkey * 10 AS any_tenfold, min(n_name) AS some_name FROM nation GROUP BY n_regionkey")
def _(lake):
    n = lake.table("nation").withColumn("tenfold", c("n_regionkey") * 10)  # equal within a group, so any value is the value
    return n.groupBy("n_regionkey").agg(F.any_value("tenfold").alias("any_tenfold"), F.min("n_name").alias("some_name"))


@query("ag11_bool_or", "SELECT user_id, bool_or(event_type = 'purchase') AS bought, bool_or(value > 400) AS spent_much FROM events GROUP BY 1")
def _(lake):
    return lake.table("events").groupBy("user_id").agg(F.bool_or(c("event_type") == "purchase").alias("bought"),
                                                       F.bool_or(c("value") > 400).alias("spent_much"))


@query("ag12_listagg", """SELECT o_orderkey, listagg(l_linenumber, '_|_' ORDER BY l_linenumber) AS lines,
listagg(l_partkey, ',' ORDER BY l_shipdate DESC, l_partkey DESC) AS newest_first, listagg(DISTINCT l_quantity, '; ' ORDER BY l_quantity) AS quantities,
listagg(DISTINCT l_linenumber, '' ORDER BY l_linenumber DESC) AS last_first, listagg(CASE WHEN l_returnflag = 'R' THEN l_linenumber END, ',' ORDER BY l_linenumber) AS returned
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_returnflag, CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem) JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def _(lake):
    lines = lake.table("lineitem").join(lake.table("orders").select("o_orderkey"), c("l_orderkey") == c("o_orderkey")).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_shipdate", c("l_quantity").cast("int").alias("l_quantity"),
        F.when(c("l_returnflag") == "R", c("l_linenumber")).alias("returned_line"))  # NULL throughout for many orders
    parts = [aggregates.listagg(lines, ["o_orderkey"], "l_linenumber", "_|_", name="lines"),
             aggregates.listagg(lines, ["o_orderkey"], "l_partkey", order_by="l_shipdate", descending=True, name="newest_first"),
             aggregates.listagg(lines, ["o_orderkey"], "l_quantity", "; ", distinct=True, name="quantities"),
             aggregates.listagg(lines, ["o_orderkey"], "l_linenumber", "", distinct=True, descending=True, name="last_first"),
             aggregates.listagg(lines, ["o_orderkey"], "returned_line", name="returned")]
    return reduce(lambda x, y: x.join(y, "o_orderkey"), parts)


@query("ag12_listagg_limited", """SELECT user_id, listagg(event_type, ', ' ORDER BY ts, event_id) AS first_events
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 3) GROUP BY 1""")
def _(lake):
    return aggregates.listagg_first(lake.table("events"), ["user_id"], "event_type", [c("ts").asc(), c("event_id").asc()],
                                    3, ", ", "first_events")


@query("ag13_watermark", "SELECT coalesce(max(_ingestion_ts), TIMESTAMP '1970-01-01') AS watermark FROM bronze_payments")
def _(lake):
    return aggregates.watermark(lake.bronze("payments"))


@query("ag14_not_null_share", "SELECT avg(CASE WHEN email IS NOT NULL THEN 1.0 ELSE 0 END) AS email_share, avg(CASE WHEN gender IS NOT NULL THEN 1.0 ELSE 0 END) AS gender_share FROM bronze_customers")
def _(lake):
    return lake.bronze("customers").agg(aggregates.not_null_share(c("email")).alias("email_share"),
                                        aggregates.not_null_share(c("gender")).alias("gender_share"))


@query("ag15_category_counts", """SELECT o.customer_id, p.category, count(*) AS purchases FROM bronze_order_items i
JOIN stg_products p ON i.product_id = p.product_id JOIN stg_orders o ON i.order_id = o.order_id GROUP BY 1, 2""")
def _(lake):
    return aggregates.category_counts(lake.bronze("order_items"), staging(lake, "products"), staging(lake, "orders"))


@query("ag16_order_subtotals", "SELECT order_id, CAST(round(sum(round(unit_price * quantity, 2)), 2) AS DOUBLE) AS subtotal, count(*) AS n_lines FROM bronze_order_items GROUP BY 1")
def _(lake):
    return aggregates.order_subtotals(lake.bronze("order_items"))


# -- windows -----------------------------------------------------------------------------------------

@query("wn1_latest_version", """SELECT "payment-id" AS payment_id, _record_hash FROM bronze_payments
QUALIFY row_number() OVER (PARTITION BY "payment-id" ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1""")
def _(lake):
    return dedupe.latest_per_key(lake.bronze("payments"), ["payment-id"]).select(c("`payment-id`").alias("payment_id"), "_record_hash")


@query("wn2_best_payment", """SELECT order_id, payment_id, payment_status, payment_date FROM stg_payments QUALIFY row_number() OVER (PARTITION BY order_id
ORDER BY CASE WHEN payment_status = 'completed' THEN 0 ELSE 1 END, payment_date DESC NULLS LAST, payment_id DESC) = 1""")
def _(lake):
    return gold.best_payment(staging(lake, "payments")).select("order_id", "payment_id", "payment_status", "payment_date")


@query("wn3_latest_shipment", """SELECT order_id, tracking_number, status FROM stg_shipments QUALIFY row_number() OVER (PARTITION BY order_id
ORDER BY coalesce(actual_delivery_date, shipment_date, created_at) DESC NULLS LAST, tracking_number DESC) = 1""")
def _(lake):
    return gold.latest_shipment(staging(lake, "shipments")).select("order_id", "tracking_number", "status")


@query("wn4_global_ntile", """SELECT o_orderkey, ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS price_tile,
6 - ntile(5) OVER (ORDER BY o_orderdate DESC, o_orderkey) AS age_score FROM orders""")
def _(lake):
    o = lake.table("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tiles = ordered.ntile_columns(o, 5, {"price_tile": [c("o_totalprice").asc(), c("o_orderkey").asc()],
                                         "t": [c("o_orderdate").desc(), c("o_orderkey").asc()]})
    return tiles.select("o_orderkey", "price_tile", (6 - c("t")).alias("age_score"))


@query("wn5_lead_and_last", """SELECT user_id, event_id, ts, lead(ts) OVER w AS next_ts, lead(ts) OVER w IS NULL AS is_last
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(lake):
    e = lake.table("events").select("user_id", "event_id", "ts")
    pairs = ordered.neighbour(e, [c("ts").asc(), c("event_id").asc()], {"ts": "next_ts"}, 1, ["user_id"], exists="more")
    return pairs.select("user_id", "event_id", "ts", "next_ts", (~c("more")).alias("is_last"))


@query("wn6_lag_over_whole_table", "SELECT event_id, ts, lag(ts) OVER (ORDER BY ts, event_id) AS previous_ts FROM events")
def _(lake):
    e = lake.table("events").select("event_id", "ts")
    return ordered.neighbour(e, [c("ts").asc(), c("event_id").asc()], {"ts": "previous_ts"}, -1).select(
        "event_id", "ts", "previous_ts")


@query("wn7_row_offset", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders")
def _(lake):
    o = lake.table("orders").select("o_orderkey", "o_orderdate")
    return ordered.row_numbers(o, [c("o_orderdate").asc(), c("o_orderkey").asc()], "n").select(
        "o_orderkey", (c("n") - 1).alias("position"))


@query("wn8_deduplicate", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey) = 1""")
def _(lake):
    return dedupe.first_per_key(lake.table("lineitem"), ["l_orderkey", "l_linenumber"],
                                [c("l_shipdate").desc(), c("l_extendedprice").desc(), c("l_partkey").asc()]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


_HISTORY = """SELECT o.order_id, o.customer_id, count(q.order_id) AS previous_orders,
CAST(coalesce(sum(CASE WHEN q.order_date >= o.order_date - INTERVAL 180 DAY THEN q.total_amount END), 0) AS DOUBLE) AS recent_spend
FROM stg_orders o LEFT JOIN stg_orders q ON q.customer_id = o.customer_id AND (q.order_date, q.order_id) < (o.order_date, o.order_id)
GROUP BY 1, 2"""


@query("wn9_history_at_order_time", _HISTORY)
def _(lake):
    return history.order_history(staging(lake, "orders")).select("order_id", "customer_id", "previous_orders", "recent_spend")


# -- sorts, pages and set operations -----------------------------------------------------------------

@query("so1_page_rows", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000 OFFSET 500")
def _(lake):
    return paging.page(lake.table("orders").select("o_orderkey", "o_orderdate"), [c("o_orderdate").asc(), c("o_orderkey").asc()], 1000, 500)


@query("so1_page_info", """SELECT count(*) AS total_count, CAST(greatest(0, least(1000, count(*) - 500)) AS BIGINT) AS count, 1000 AS "limit", 500 AS "offset",
count(*) > 1500 AS has_more, CASE WHEN count(*) > 1500 THEN 1500 END AS next_offset FROM orders""")
def _(lake):
    return paging.page_info(lake.table("orders"), 1000, 500)


@query("so1_page_after_key", """SELECT o_orderkey, o_orderdate FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-01', 5)
ORDER BY o_orderdate, o_orderkey LIMIT 1000""")
def _(lake):
    import datetime
    return paging.page_after(lake.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey",
                             (datetime.datetime(1998, 1, 1), 5), 1000)


@query("so2_ordered_extract", "SELECT order_id, updated_at FROM bronze_orders ORDER BY updated_at, order_id")
def _(lake):
    return lake.bronze("orders").select("order_id", "updated_at").orderBy("updated_at", "order_id")


@query("so3_column_values", """SELECT p_brand AS value, count(*) AS n_rows FROM part WHERE p_size > 10 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(lake):
    return reshape.column_values(lake.table("part"), "p_brand", max_records=10, where="p_size > 10")


@query("st1_union_relations", """SELECT 'customers' AS source_relation, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS seg, CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL SELECT 'suppliers', s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""")
def _(lake):
    cu = lake.table("customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_acctbal").alias("balance"),
                                       c("c_mktsegment").alias("seg"))
    su = lake.table("supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_acctbal").alias("balance"),
                                       c("s_nationkey").alias("nation"))
    return reshape.union_relations({"customers": cu, "suppliers": su})


@query("st2_except", f"{_A} EXCEPT {_B}")
def _(lake):
    a, b = _halves(lake)
    return a.subtract(b)


@query("st3_intersect", f"{_A} INTERSECT {_B}")
def _(lake):
    a, b = _halves(lake)
    return a.intersect(b)


@query("st4_union_all", f"{_A} UNION ALL {_B} UNION ALL {_A}")
def _(lake):
    a, b = _halves(lake)
    return reduce(DataFrame.unionByName, [a, b, a])


# -- reshape -----------------------------------------------------------------------------------------

_TYPES = ["view", "click", "purchase", "signup", "error", "blue's"]


@query("rs1_pivot", "SELECT user_id, " + ", ".join(
    f"""CAST(sum(CASE WHEN event_type = '{t.replace("'", "''")}' THEN 1 ELSE 0 END) AS BIGINT) AS "n_{t}\"""" for t in _TYPES)
    + ", max(CASE WHEN event_type = 'purchase' THEN value END) AS max_purchase FROM events GROUP BY 1")
def _(lake):
    e = lake.table("events")
    return e.groupBy("user_id").agg(*reshape.pivot(c("event_type"), _TYPES, prefix="n_"),
                                    *reshape.pivot(c("event_type"), ["purchase"], agg=F.max, then_value=c("value"), else_value=None, prefix="max_"))


@query("rs2_unpivot", " UNION ALL ".join(
    f"SELECT customer_id, updated_at, '{n}' AS prop, CAST({n} AS VARCHAR) AS val FROM stg_customers"
    for n in ("email", "phone", "gender", "is_adult", "is_valid_email")))
def _(lake):
    cu = staging(lake, "customers").select("customer_id", "updated_at", "email", "phone", "gender", "is_adult", "is_valid_email", "state")
    return reshape.unpivot(cu, exclude=["customer_id", "updated_at"], remove=["STATE"], field_name="prop", value_name="val")


@query("rs3_generate_series", "SELECT unnest(range(1, (SELECT count(*) FROM orders) + 1)) AS generated_number")
def _(lake):
    return reshape.generate_series(lake.spark, lake.table("orders").count())


@query("rs4_date_spine", """SELECT unnest(generate_series(date_trunc('day', (SELECT min(o_orderdate) FROM orders)),
date_trunc('day', (SELECT max(o_orderdate) FROM orders)) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS date_day""")
def _(lake):
    bounds = lake.table("orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return reshape.date_spine(bounds, "day", c("first"), c("last")).select("date_day")


@query("rs4_month_spine_per_customer", """SELECT o_custkey, unnest(generate_series(first, last - INTERVAL 1 MICROSECOND, INTERVAL 1 MONTH)) AS date_month
FROM (SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS first, max(o_orderdate) AS last FROM orders GROUP BY 1) WHERE first < last""")
def _(lake):
    spans = lake.table("orders").groupBy("o_custkey").agg(F.date_trunc("month", F.min("o_orderdate")).alias("first"),
                                                          F.max("o_orderdate").alias("last"))
    return reshape.date_spine(spans, "month", c("first"), c("last")).select("o_custkey", "date_month")


@query("rs5_star", "SELECT p_partkey AS old_p_partkey_x, p_name AS old_p_name_x, p_type AS old_p_type_x FROM part")
def _(lake):
    p = lake.table("part")
    return p.select(*reshape.star(p, ["P_BRAND", "p_size", "p_retailprice"], "old_", "_x"))


@query("rs6_filtered_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(lake):
    s = lake.table("supplier")
    return s.select(reshape.filtered_columns(s, ["S_NATIONKEY", "s_acctbal"]))


@query("rs7_null_check", "SELECT page_id, nullif(tail, '') AS tail, nullif(host, '') AS host FROM (SELECT page_id, split_part(url, '?', 2) AS tail, split_part(url, '/', 3) AS host FROM pages)")
def _(lake):
    p = lake.table("pages").select("page_id", F.split_part("url", F.lit("?"), F.lit(2)).alias("tail"),
                                   F.split_part("url", F.lit("/"), F.lit(3)).alias("host"))
    return reshape.null_check(p)


@query("rs8_snake_case", 'SELECT "payment-id" AS payment_id, "card-last-4" AS card_last_4, "payment-date" AS payment_date FROM bronze_payments')
def _(lake):
    return reshape.snake_case(lake.bronze("payments")).select("payment_id", "card_last_4", "payment_date")


@query("rs9_relations_by_pattern", """SELECT 'tidemark_events_a' AS source_relation, event_id, user_id, event_type FROM events WHERE event_type IN ('view', 'click')
UNION ALL SELECT 'tidemark_events_b', event_id, user_id, event_type FROM events WHERE event_type NOT IN ('view', 'click')""")
def _(lake):
    e = lake.table("events").select("event_id", "user_id", "event_type")
    e.where("event_type in ('view', 'click')").createOrReplaceTempView("tidemark_events_a")
    e.where("event_type not in ('view', 'click')").createOrReplaceTempView("tidemark_events_b")
    database = lake.spark.catalog.currentDatabase()
    names = reshape.tables_with_prefix(lake.spark, database, "TIDEMARK_EVENTS_", exclude="%_tmp")
    return reshape.union_relations({n: lake.spark.table(n) for n in names})


@query("rs10_results_as_dict", "SELECT event_id, event_type FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 HAVING max(value) > 250)")
def _(lake):
    e = lake.table("events")
    wanted = reshape.results_as_dict(e.groupBy("event_type").agg(F.max("value").alias("top")).where("top > 250"))  # a handful of types
    return e.where(c("event_type").isin(wanted["event_type"])).select("event_id", "event_type")
