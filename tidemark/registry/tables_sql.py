"""SQL twins of the bronze, silver and gold tables, for checking results with another engine.

They repeat the fixed projections of ``tidemark.sources.bronze`` and the rules of ``tidemark.plans``.
"""

_COUNTRY = "['United States','Canada','United Kingdom','Germany','France','Italy','Spain','Japan','Netherlands','Australia']"
_CARRIER = "['UPS','FedEx','USPS','DHL']"
_METHOD = "['Credit_Card','PayPal','APPLE_PAY','google_pay']"
_BRAND = "['Visa','MasterCard','AMEX','Discover']"


def _batch(ts: str, v: str) -> str:
    return f"make_timestamp(year({ts}) + 1, 1, {v}, 0, 0, 0)"


def _parse(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}(T.*)?') THEN try_cast({c} AS TIMESTAMP) "
            f"WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') THEN try_cast({c} AS TIMESTAMP) END")


def _parsed(raw: str, clean: str) -> str:
    value = _parse(f'"{raw}"')
    return f'{value} AS {clean}, ({value}) IS NULL AND "{raw}" IS NOT NULL AS {clean}_parse_error'


def _latest(source: str, key: str) -> str:
    return (f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} "
            "ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1")


_LINE_BASE = "SELECT *, l_shipdate + to_seconds(l_partkey % 86400) AS shipped FROM lineitem"
_LINE_AUDIT = f"""
  {_batch('shipped', '1')} AS _ingestion_ts, 'api' AS _source_system,
  md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(CAST(l_quantity AS DECIMAL(12,2)) * 100 AS BIGINT), CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT),
      strftime(l_shipdate, '%Y-%m-%d'))) AS _record_hash,
  'full' AS load_type, CAST({_batch('shipped', '1')} AS DATE) AS ingestion_date"""


def _average(total: str, n: str) -> str:
    """total / n to two decimals, halves away from zero, in whole-number arithmetic."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"sign({cents}) * ((2 * abs({cents}) + {n}) // (2 * {n})) / 100.0"


_SPACED = "'%Y-%m-%d %H:%M:%S'"
_ISO = "'%Y-%m-%dT%H:%M:%S'"
_AUDIT = "_ingestion_ts, _source_system, _record_hash, ingestion_date"

TABLES: dict[str, str] = {}

TABLES["bronze_customers"] = f"""
SELECT id AS customer_id, split_part(name, '#', 1) AS first_name, split_part(name, '#', 2) AS last_name,
  CASE WHEN seg = 'HOUSEHOLD' THEN '  ' || upper(replace(name, '#', '.')) || '@Example.COM '
       WHEN seg = 'MACHINERY' THEN NULL WHEN seg = 'FURNITURE' THEN name
       ELSE lower(replace(name, '#', '.')) || '@example.org' END AS email,
  CASE WHEN seg = 'MACHINERY' THEN '  ' WHEN balance < 1000 THEN NULL ELSE '+1-' || seq END AS phone,
  CASE WHEN seg = 'PARTNER' THEN n_name ELSE {_COUNTRY}[nationkey % 10 + 1] END AS country,
  'City ' || nationkey AS city, 'S' || (nationkey % 5) AS state, lpad(CAST(seq % 100000 AS VARCHAR), 5, '0') AS postal_code,
  name || ' Street' AS address, signup AS signup_date, signup AS created_at,
  signup + to_days(CAST(nationkey + v AS INTEGER)) AS updated_at,
  CASE WHEN v < versions THEN 'New' WHEN seg IN ('AUTOMOBILE','BUILDING') THEN 'VIP'
       WHEN seg IN ('FURNITURE','HOUSEHOLD') THEN 'Regular' ELSE 'New' END AS customer_segment,
  CASE WHEN seg <> 'BUILDING' THEN DATE '1950-01-01' + CAST(seq * 37 % 25000 AS INTEGER) END AS date_of_birth,
  CASE nationkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Other' END AS gender,
  {_batch('signup', 'v')} AS _ingestion_ts, 'rds' AS _source_system, md5(concat_ws('|', id, seg, v)) AS _record_hash,
  CASE WHEN v = 1 THEN 'full' ELSE 'incremental' END AS load_type, CAST({_batch('signup', 'v')} AS DATE) AS ingestion_date
FROM (SELECT *, unnest(range(1, versions + 1)) AS v, TIMESTAMP '1994-06-01' + to_days(CAST(seq * 13 % 2400 AS INTEGER)) AS signup
      FROM (SELECT *, CASE WHEN seg = 'AUTOMOBILE' THEN 2 ELSE 1 END AS versions
            FROM (SELECT c_custkey * 2 AS id, c_custkey AS seq, c_name AS name, c_nationkey AS nationkey, c_acctbal AS balance,
                         c_mktsegment AS seg FROM customer
                  UNION ALL SELECT s_suppkey * 2 + 1, s_suppkey, s_name, s_nationkey, s_acctbal, 'PARTNER' FROM supplier) p
            LEFT JOIN nation ON nationkey = n_nationkey))"""

TABLES["bronze_orders"] = f"""
SELECT order_id, customer_id, ordered AS order_date,
  CASE WHEN lower(paid) <> 'pending' THEN ordered + INTERVAL 1 HOUR END AS payment_date,
  CASE WHEN shipped AND o_orderpriority <> '2-HIGH' THEN ordered + INTERVAL 1 DAY END AS shipment_date,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN ordered + INTERVAL 9 DAY END AS delivered_date,
  ordered AS created_at, ordered + to_days(CAST(v AS INTEGER)) AS updated_at, status AS order_status, paid AS payment_status,
  CAST(round(total * CAST('0.90' AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS subtotal,
  CAST(round(total * CAST('0.05' AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS discount_amount,
  CAST(round(total * CAST('0.08' AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS tax_amount,
  CAST(order_id % 20 AS DECIMAL(12,2)) AS shipping_cost,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' AND total < 50000 THEN -total ELSE total END AS total_amount,
  CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN {_METHOD}[order_id % 4 + 1] END AS payment_method,
  CASE WHEN lower(paid) <> 'pending' THEN CAST(order_id * 10 + 1 AS DECIMAL(38,0)) END AS payment_id,
  CASE WHEN shipped THEN {_CARRIER}[o_custkey % 4 + 1] END AS shipping_carrier,
  CASE WHEN shipped THEN CAST(order_id * 10 + 1 AS DECIMAL(38,0)) END AS tracking_number,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'VIP' ELSE 'Regular' END AS customer_segment_at_order,
  {_batch('ordered', 'v')} AS _ingestion_ts, 'rds' AS _source_system,
  md5(concat_ws('|', order_id, o_orderstatus, o_orderpriority, v)) AS _record_hash,
  CASE WHEN v = 1 THEN 'full' ELSE 'incremental' END AS load_type, CAST({_batch('ordered', 'v')} AS DATE) AS ingestion_date
FROM (SELECT *, lower(status) IN ('shipped','delivered','refunded') AS shipped,
        CASE WHEN total >= 490000 THEN -1 - o_custkey ELSE o_custkey * 2 END AS customer_id
      FROM (SELECT *, o_orderkey AS order_id, o_orderdate + to_seconds(o_orderkey % 86400) AS ordered,
              CAST(o_totalprice AS DECIMAL(12,2)) AS total,
              CASE WHEN v < versions THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'P' THEN 'Shipped'
                   WHEN o_orderpriority = '1-URGENT' THEN 'Processing' WHEN o_orderpriority = '2-HIGH' THEN 'shipped'
                   WHEN o_orderpriority = '3-MEDIUM' THEN 'Cancelled' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'refunded'
                   ELSE 'pending' END AS status,
              CASE WHEN v < versions THEN 'Pending' WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'Refunded'
                   WHEN o_orderstatus IN ('F','P') THEN 'COMPLETED' WHEN o_orderpriority = '3-MEDIUM' THEN 'failed'
                   WHEN o_orderpriority = '5-LOW' THEN 'pending' ELSE 'success' END AS paid
            FROM (SELECT *, unnest(range(1, versions + 1)) AS v
                  FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS versions FROM orders))))"""

TABLES["bronze_order_items"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(16,2)) AS line_total, shipped AS created_at
FROM ({_LINE_BASE})"""

TABLES["bronze_payments"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS "payment-id",
  CASE WHEN l_quantity = 50 THEN -1 - l_orderkey ELSE l_orderkey END AS "order-id", l_suppkey AS "customer-id",
  {_METHOD}[l_linenumber % 4 + 1] AS "payment-method",
  CASE WHEN l_linenumber % 4 = 0 THEN {_BRAND}[l_partkey % 4 + 1] END AS "card-brand",
  CASE WHEN l_linenumber % 4 = 0 THEN lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0') END AS "card-last-4",
  l_extendedprice AS amount,
  CASE WHEN l_returnflag = 'R' THEN 'Refunded' WHEN l_returnflag = 'A' THEN 'COMPLETED' WHEN l_linestatus = 'F' THEN 'failed'
       ELSE 'Pending' END AS "payment-status",
  CASE WHEN l_linenumber <= 3 THEN strftime(shipped, {_SPACED}) WHEN l_linenumber <= 5 THEN strftime(shipped, {_ISO})
       WHEN l_linenumber = 7 THEN '10:00:00' END AS "payment-date",
  strftime(shipped, {_SPACED}) AS "created-at", strftime(shipped + INTERVAL 1 DAY, {_ISO}) AS "updated-at", {_LINE_AUDIT}
FROM ({_LINE_BASE})"""

TABLES["bronze_shipments"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS tracking_number, 'TRK' || (l_orderkey * 10 + l_linenumber) AS tracking_code,
  CASE WHEN l_quantity = 49 THEN -1 - l_orderkey ELSE l_orderkey END AS order_id, {_CARRIER}[l_linenumber % 4 + 1] AS shipping_carrier,
  'United States' AS origin_country, {_COUNTRY}[l_suppkey % 10 + 1] AS destination_country,
  lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0') AS destination_postal_code,
  CASE WHEN l_linestatus = 'F' THEN 'Delivered' WHEN l_returnflag = 'R' THEN 'RETURNED' WHEN l_returnflag = 'A' THEN 'In_Transit'
       WHEN l_linenumber = 7 THEN 'lost' ELSE 'exception' END AS status, l_tax * 100 AS shipping_cost,
  CASE WHEN l_linenumber <> 5 THEN strftime(shipped, {_SPACED}) END AS "shipment-date",
  strftime(shipped + INTERVAL 5 DAY, {_ISO}) AS "estimated-delivery-date",
  CASE WHEN l_quantity = 13 THEN 'soon' WHEN l_linestatus = 'F' THEN strftime(shipped + INTERVAL 4 DAY, {_SPACED}) END AS "actual-delivery-date",
  strftime(shipped, {_SPACED}) AS "created-at", strftime(shipped + INTERVAL 2 DAY, {_ISO}) AS "updated-at", {_LINE_AUDIT}
FROM ({_LINE_BASE})"""

TABLES["bronze_products"] = f"""
SELECT p_partkey AS product_id, '  ' || p_name || ' ' AS product_name, p_type || ' ' AS category,
  ' ' || upper(split_part(p_name, ' ', 2)) AS sub_category, ' ' || p_brand AS brand,
  CAST(CASE WHEN v < versions THEN price + 1 ELSE price END AS DECIMAL(10,2)) AS price,
  CAST(round(price * CAST('0.60' AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS cost, created AS created_at,
  upper(split_part(p_name, ' ', 1)) || ' ' AS color,
  {_batch('created', 'v')} AS _ingestion_ts, 'rds' AS _source_system, md5(concat_ws('|', p_partkey, p_brand, v)) AS _record_hash,
  CASE WHEN v = 1 THEN 'full' ELSE 'incremental' END AS load_type, CAST({_batch('created', 'v')} AS DATE) AS ingestion_date
FROM (SELECT *, unnest(range(1, versions + 1)) AS v, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
        TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 2500 AS INTEGER)) AS created
      FROM (SELECT *, CASE WHEN p_size > 40 THEN 2 ELSE 1 END AS versions FROM part))"""

TABLES["stg_customers"] = f"""
SELECT customer_id, first_name, last_name, lower(trim(email)) AS email, phone, country, city, state, postal_code, address,
  signup_date, created_at, updated_at, customer_segment, date_of_birth, gender,
  coalesce(regexp_matches(lower(trim(email)), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$'), false) AS is_valid_email,
  date_sub('year', date_of_birth, DATE '2001-08-02') >= 18 AS is_adult,
  coalesce(trim(email) <> '', false) OR coalesce(trim(phone) <> '', false) AS has_contact, {_AUDIT}
FROM ({_latest('bronze_customers', 'customer_id')})"""

TABLES["stg_orders"] = f"""
SELECT order_id, customer_id, order_date, payment_date, shipment_date, delivered_date, created_at, updated_at,
  lower(order_status) AS order_status, lower(payment_status) AS payment_status, subtotal, discount_amount, tax_amount,
  shipping_cost, total_amount, lower(payment_method) AS payment_method, CAST(payment_id AS BIGINT) AS payment_id,
  shipping_carrier, CAST(CAST(tracking_number AS BIGINT) AS VARCHAR) AS tracking_number, customer_segment_at_order,
  lower(payment_status) IN ('completed','success') AS is_paid,
  lower(order_status) = 'delivered' OR delivered_date IS NOT NULL AS is_delivered,
  lower(order_status) = 'refunded' OR lower(payment_status) = 'refunded' AS is_refunded,
  lower(order_status) = 'cancelled' AS is_cancelled, {_AUDIT}
FROM ({_latest('bronze_orders', 'order_id')})"""

TABLES["stg_payments"] = f"""
SELECT CAST("payment-id" AS BIGINT) AS payment_id, CAST("order-id" AS BIGINT) AS order_id, CAST("customer-id" AS BIGINT) AS customer_id,
  lower("payment-method") AS payment_method, lower("card-brand") AS card_brand, "card-last-4" AS card_last_4,
  CAST(amount AS DECIMAL(12,2)) AS amount, lower("payment-status") AS payment_status,
  {_parsed('payment-date', 'payment_date')}, {_parsed('created-at', 'created_at')}, {_parsed('updated-at', 'updated_at')}, {_AUDIT}
FROM ({_latest('bronze_payments', '"payment-id"')})"""

TABLES["stg_products"] = f"""
SELECT product_id, trim(product_name) AS product_name, lower(trim(category)) AS category, lower(trim(sub_category)) AS sub_category,
  trim(brand) AS brand, price, cost, created_at, lower(trim(color)) AS color, {_AUDIT}
FROM ({_latest('bronze_products', 'product_id')})"""

TABLES["stg_shipments"] = f"""
SELECT tracking_number, tracking_code, order_id, shipping_carrier, origin_country, destination_country, destination_postal_code,
  lower(status) AS status, CAST(shipping_cost AS DECIMAL(10,2)) AS shipping_cost, {_parsed('shipment-date', 'shipment_date')},
  {_parsed('estimated-delivery-date', 'estimated_delivery_date')}, {_parsed('actual-delivery-date', 'actual_delivery_date')},
  {_parsed('created-at', 'created_at')}, {_parsed('updated-at', 'updated_at')}, {_AUDIT}
FROM ({_latest('bronze_shipments', 'tracking_number')})"""

TABLES["order_facts"] = """
SELECT o.order_id, o.customer_id, o.order_date, o.order_status, o.payment_status, o.payment_method,
  coalesce(p.amount, o.total_amount) AS payment_amount, coalesce(p.payment_date, o.payment_date) AS payment_date,
  s.status AS shipment_status, coalesce(s.shipping_carrier, o.shipping_carrier) AS shipping_carrier,
  coalesce(CAST(s.tracking_number AS VARCHAR), o.tracking_number) AS tracking_number, s.shipment_date, s.estimated_delivery_date,
  s.actual_delivery_date, o.subtotal, o.discount_amount, o.tax_amount, o.shipping_cost, o.total_amount,
  o._ingestion_ts AS _ingestion_ts_orders, CAST(o.order_date AS DATE) AS order_date_partition
FROM stg_orders o
LEFT JOIN (SELECT * FROM stg_payments QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY CASE WHEN payment_status = 'completed' THEN 0 ELSE 1 END, payment_date DESC NULLS LAST, payment_id DESC) = 1) p
  ON o.order_id = p.order_id
LEFT JOIN (SELECT * FROM stg_shipments QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY coalesce(actual_delivery_date, shipment_date, created_at) DESC NULLS LAST, tracking_number DESC) = 1) s
  ON o.order_id = s.order_id"""

TABLES["daily_metrics"] = f"""
SELECT count(DISTINCT order_id) AS total_orders, coalesce(sum(total_amount), 0) AS total_revenue,
  {_average('sum(total_amount)', 'count(DISTINCT order_id)')} AS avg_order_value,
  count(DISTINCT CASE WHEN payment_status IN ('completed','success') THEN order_id END) AS paid_orders,
  count(DISTINCT CASE WHEN shipment_status = 'delivered' OR actual_delivery_date IS NOT NULL THEN order_id END) AS delivered_orders,
  coalesce(sum(CASE WHEN total_amount < 0 THEN total_amount WHEN payment_status = 'refunded' THEN -total_amount ELSE 0 END), 0) AS refund_amounts,
  CAST(order_date AS DATE) AS day
FROM order_facts WHERE order_date IS NOT NULL GROUP BY CAST(order_date AS DATE)"""

TABLES["customer_360"] = f"""
SELECT c.customer_id, c.email, co.first_order_date, co.last_order_date, coalesce(co.total_orders, 0) AS total_orders,
  coalesce(co.total_revenue, 0) AS total_revenue,
  CASE WHEN co.total_orders > 0 THEN {_average('co.total_revenue', 'co.total_orders')} ELSE 0 END AS avg_order_value,
  date_diff('day', CAST(co.last_order_date AS DATE), DATE '2001-08-02') AS days_since_last_order,
  pp.payment_method AS preferred_payment_method, pc.shipping_carrier AS preferred_shipping_carrier
FROM stg_customers c
LEFT JOIN (SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
             count(DISTINCT order_id) AS total_orders, sum(total_amount) AS total_revenue FROM order_facts GROUP BY 1) co
  ON c.customer_id = co.customer_id
LEFT JOIN (SELECT customer_id, payment_method FROM order_facts WHERE payment_method IS NOT NULL GROUP BY 1, 2
           QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, max(order_date) DESC, payment_method DESC) = 1) pp
  ON c.customer_id = pp.customer_id
LEFT JOIN (SELECT customer_id, shipping_carrier FROM order_facts WHERE shipping_carrier IS NOT NULL GROUP BY 1, 2
           QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, max(order_date) DESC, shipping_carrier DESC) = 1) pc
  ON c.customer_id = pc.customer_id"""

TABLES["rfm_scores"] = """
SELECT customer_id, recency_days, frequency, monetary, r_score, f_score, m_score,
  CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_score_string,
  r_score * 100 + f_score * 10 + m_score AS rfm_score_numeric
FROM (SELECT customer_id, days_since_last_order AS recency_days, total_orders AS frequency, total_revenue AS monetary,
        6 - ntile(5) OVER (ORDER BY days_since_last_order, customer_id) AS r_score,
        ntile(5) OVER (ORDER BY total_orders, customer_id) AS f_score,
        ntile(5) OVER (ORDER BY total_revenue, customer_id) AS m_score
      FROM customer_360 WHERE total_orders > 0 AND days_since_last_order IS NOT NULL)"""
