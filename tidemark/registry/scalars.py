"""Scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import arrays, numeric, text, timestamps, web
from tidemark.registry.core import as_of, query
from tidemark.plans.silver import EMAIL_PATTERN

c = F.col

_ISO_SQL = """CASE WHEN regexp_full_match(raw, '\\d{4}-\\d{2}-\\d{2}(T.*)?') THEN try_cast(raw AS TIMESTAMP) END"""
_ANY_SQL = f"""coalesce({_ISO_SQL}, CASE WHEN regexp_full_match(raw, '\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') THEN try_cast(raw AS TIMESTAMP) END)"""


def _parse_query(lake, parser):
    df = lake.bronze("payments").select(c("`payment-id`").alias("payment_id"), c("`payment-date`").alias("raw"))
    return df.select("payment_id", "raw", *[e.alias(n) for n, e in
                                            timestamps.parse_timestamp_safe("raw", "parsed", parser).items()])


_PARSE_FROM = 'FROM (SELECT "payment-id" AS payment_id, "payment-date" AS raw FROM bronze_payments)'


@query("sc1_parse_timestamp_safe", f"""SELECT payment_id, raw, {_ISO_SQL} AS parsed,
({_ISO_SQL}) IS NULL AND raw IS NOT NULL AS parsed_parse_error {_PARSE_FROM}""")
def _(lake):
    return _parse_query(lake, timestamps.parse_iso)


@query("sc2_parse_timestamp_two_formats", f"""SELECT payment_id, raw, {_ANY_SQL} AS parsed,
({_ANY_SQL}) IS NULL AND raw IS NOT NULL AS parsed_parse_error {_PARSE_FROM}""")
def _(lake):
    return _parse_query(lake, timestamps.parse_any)


@query("sc3_lower_trim", "SELECT product_id, lower(color) AS low, trim(brand) AS trimmed, lower(trim(category)) AS both_ FROM bronze_products")
def _(lake):
    return lake.bronze("products").select("product_id", F.lower("color").alias("low"), F.trim("brand").alias("trimmed"),
                                          F.lower(F.trim("category")).alias("both_"))


@query("sc4_regexp_like", f"""SELECT customer_id, email, regexp_matches(lower(trim(email)), '{EMAIL_PATTERN}') AS matches
FROM bronze_customers""")
def _(lake):
    return lake.bronze("customers").select("customer_id", "email",
                                           F.lower(F.trim("email")).rlike(EMAIL_PATTERN).alias("matches"))


@query("sc5_coalesce_nullif_case", """SELECT order_id, coalesce(delivered_date, shipment_date, order_date) AS moved,
nullif(lower(payment_status), 'pending') AS settled,
CASE WHEN total_amount < 0 THEN 'refund' WHEN total_amount < 100000 THEN 'small' ELSE 'large' END AS size FROM bronze_orders""")
def _(lake):
    return lake.bronze("orders").select(
        "order_id", F.coalesce("delivered_date", "shipment_date", "order_date").alias("moved"),
        F.nullif(F.lower("payment_status"), F.lit("pending")).alias("settled"),
        F.when(c("total_amount") < 0, "refund").when(c("total_amount") < 100000, "small").otherwise("large").alias("size"))


@query("sc6_cast_try_cast", """SELECT "payment-id" AS payment_id, CAST("payment-id" AS VARCHAR) AS id_text,
CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, try_cast("payment-date" AS DATE) IS NULL AS not_a_date,
try_cast("card-last-4" AS INTEGER) AS last_4 FROM bronze_payments""")
def _(lake):
    p = lake.bronze("payments")
    return p.select(c("`payment-id`").alias("payment_id"), c("`payment-id`").cast("string").alias("id_text"),
                    c("amount").cast("decimal(12,2)").alias("amount"),
                    timestamps.date_or_null("payment-date").isNull().alias("not_a_date"),
                    c("`card-last-4`").try_cast("int").alias("last_4"))


@query("sc7_safe_cast", "SELECT o_orderkey, o_orderpriority, try_cast(o_orderpriority AS INTEGER) AS as_int, try_cast(o_orderpriority[1:1] AS INTEGER) AS first_int FROM orders")
def _(lake):
    return lake.table("orders").select(
        "o_orderkey", "o_orderpriority", text.safe_cast(c("o_orderpriority"), "int").alias("as_int"),
        text.safe_cast(F.substring("o_orderpriority", 1, 1), "int").alias("first_int"))


@query("sc8_date_of_timestamp", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(lake):
    return lake.table("events").select("event_id", F.to_date("ts").alias("day"))


@query("sc9_date_diff_complete", """SELECT customer_id, date_sub('year', date_of_birth, DATE '2001-08-02') AS age,
date_diff('day', CAST(signup_date AS DATE), DATE '2001-08-02') AS days_known FROM bronze_customers""")
def _(lake):
    return lake.bronze("customers").select(
        "customer_id", timestamps.complete_years(c("date_of_birth"), as_of()).alias("age"),
        F.datediff(as_of(), F.to_date("signup_date")).cast("bigint").alias("days_known"))


@query("sc10_date_add", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 7 AS week_before, CAST(o_orderdate AS DATE) + 30 AS due FROM orders")
def _(lake):
    day = F.to_date("o_orderdate")
    return lake.table("orders").select("o_orderkey", F.date_sub(day, 7).alias("week_before"), F.date_add(day, 30).alias("due"))


_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


@query("sc11_dateadd", "SELECT event_id, " + ", ".join(
    f"ts + INTERVAL 3 {p.upper()} AS plus_{p}" for p in _PARTS) + ", ts - INTERVAL 5 DAY AS minus_days FROM events")
def _(lake):
    return lake.table("events").select("event_id", *[timestamps.dateadd(p, 3, c("ts")).alias(f"plus_{p}") for p in _PARTS],
                                       timestamps.dateadd("day", -5, c("ts")).alias("minus_days"))


@query("sc12_datediff_boundaries", "SELECT \"payment-id\" AS payment_id, " + ", ".join(
    # the week difference of this engine counts complete weeks, hence the Mondays
    f"date_diff('{p}', a, b) AS diff_{p}" if p != "week" else
    "date_diff('day', date_trunc('week', a), date_trunc('week', b)) // 7 AS diff_week" for p in _PARTS) + """ FROM (SELECT "payment-id", CAST("created-at" AS TIMESTAMP) AS a,
CASE WHEN "payment-date" <> '10:00:00' THEN CAST("updated-at" AS TIMESTAMP) + to_days(CAST("customer-id" AS INTEGER)) END AS b FROM bronze_payments)""")
def _(lake):
    p = lake.bronze("payments").select(
        c("`payment-id`").alias("payment_id"), timestamps.parse_any("created-at").alias("a"),
        F.when(c("`payment-date`") != "10:00:00",
               timestamps.dateadd("day", c("`customer-id`").cast("int"), timestamps.parse_any("updated-at"))).alias("b"))
    return p.select("payment_id", *[timestamps.datediff(x, c("a"), c("b")).alias(f"diff_{x}") for x in _PARTS])


@query("sc13_date_trunc", "SELECT event_id, " + ", ".join(
    f"CAST(date_trunc('{p}', ts) AS TIMESTAMP) AS {p}_start" for p in _PARTS) + " FROM events")
def _(lake):
    return lake.table("events").select("event_id", *[timestamps.date_trunc(p, c("ts")).alias(f"{p}_start") for p in _PARTS])


@query("sc14_last_day", """SELECT o_orderkey, last_day(o_orderdate) AS month_end,
CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end FROM orders""")
def _(lake):
    day = F.to_date("o_orderdate")
    return lake.table("orders").select("o_orderkey", *[timestamps.last_day(p, day).alias(f"{p}_end")
                                                       for p in ("month", "quarter", "year")])


@query("sc15_current_timestamp", """SELECT o_orderkey, date_diff('day', o_orderdate, current_timestamp::TIMESTAMP) // 7 AS weeks_ago,
o_orderdate + INTERVAL 25 YEAR < current_timestamp::TIMESTAMP AS long_ago, o_orderdate + INTERVAL 9000 DAY > current_timestamp::TIMESTAMP - INTERVAL 1 DAY AS ahead FROM orders""")
def _(lake):
    now, at = timestamps.current_timestamp_utc(), c("o_orderdate")
    return lake.table("orders").select("o_orderkey", F.floor(F.datediff(F.to_date(now), F.to_date(at)) / 7).alias("weeks_ago"),
                                       (F.timestamp_add("YEAR", F.lit(25), at) < now).alias("long_ago"),
                                       (F.timestamp_add("DAY", F.lit(9000), at) > F.timestamp_add("DAY", F.lit(-1), now)).alias("ahead"))


@query("sc16_hash", "SELECT p_partkey, md5(p_name) AS name_hash, md5(CAST(p_partkey AS VARCHAR)) AS key_hash FROM part")
def _(lake):
    return lake.table("part").select("p_partkey", text.md5_hash(c("p_name")).alias("name_hash"),
                                     text.md5_hash(c("p_partkey")).alias("key_hash"))


@query("sc17_surrogate_key", """SELECT customer_id, _ingestion_ts, md5(coalesce(CAST(customer_id AS VARCHAR), '') || '-' || coalesce(email, '') || '-' ||
coalesce(phone, '') || '-' || coalesce(gender, '')) AS key FROM bronze_customers""")
def _(lake):
    cols = [c(n) for n in ("customer_id", "email", "phone", "gender")]
    return lake.bronze("customers").select("customer_id", "_ingestion_ts", text.surrogate_key(cols).alias("key"))


@query("sc18_concat", "SELECT customer_id, _ingestion_ts, first_name || ' ' || last_name AS name, email || phone AS contact FROM bronze_customers")
def _(lake):
    return lake.bronze("customers").select("customer_id", "_ingestion_ts",
                                           text.concat([c("first_name"), F.lit(" "), c("last_name")]).alias("name"),
                                           text.concat([c("email"), c("phone")]).alias("contact"))


@query("sc19_string_functions", """SELECT doc_id, replace(text, 'the', 'THE') AS replaced, right(text, 12) AS tail, length(text) AS n,
position('the' IN text) AS first_the, split_part(text, ' ', 3) AS third_word, source FROM documents""")
def _(lake):
    t = c("text")
    return lake.table("documents").select(
        "doc_id", F.replace(t, F.lit("the"), F.lit("THE")).alias("replaced"), text.right(t, F.lit(12)).alias("tail"),
        F.length(t).alias("n"), F.position(F.lit("the"), t).alias("first_the"),
        F.split_part(t, F.lit(" "), F.lit(3)).alias("third_word"), "source")


@query("sc20_bool_to_text", "SELECT doc_id, CAST(quality = 1 AS VARCHAR) AS is_good, CAST(toxic = 1 AS VARCHAR) AS is_toxic FROM labels")
def _(lake):
    return lake.table("labels").select("doc_id", text.bool_to_text(c("quality") == 1).alias("is_good"),
                                       text.bool_to_text(c("toxic") == 1).alias("is_toxic"))


@query("sc21_quotes_and_identifiers", """SELECT "payment-id" AS "it's an id", 'blue''s' AS literal, "payment-method" || '''s' AS owned
FROM bronze_payments""")
def _(lake):
    return lake.bronze("payments").select(
        F.col(text.quote_name("payment-id")).alias("it's an id"), F.lit("blue's").alias("literal"),
        F.concat(F.col(text.quote_name("payment-method")), F.lit("'s")).alias("owned"))


@query("sc22_safe_add", """SELECT order_id, _ingestion_ts, CAST(coalesce(payment_id, 0) + coalesce(tracking_number, 0) + order_id AS DOUBLE) AS total
FROM bronze_orders""")
def _(lake):
    total = numeric.safe_add([c("payment_id").cast("bigint"), c("tracking_number").cast("bigint"), c("order_id")])
    return lake.bronze("orders").select("order_id", "_ingestion_ts", total.cast("double").alias("total"))


_POINT = "CAST(l_quantity * 3 - 75 AS DOUBLE) AS lat1, CAST(l_suppkey % 360 - 180 AS DOUBLE) AS lon1, CAST(l_linenumber * 20 - 70 AS DOUBLE) AS lat2, CAST(l_partkey % 360 - 180 AS DOUBLE) AS lon2"
_MILES = """2 * 3961 * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))"""


@query("sc23_haversine_distance", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, round({_MILES}, 3) AS miles,
round({_MILES} * 1.60934, 3) AS km FROM (SELECT *, {_POINT} FROM lineitem)""")
def _(lake):
    points = lake.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        (c("l_quantity") * 3 - 75).alias("lat1"), (c("l_suppkey") % 360 - 180).cast("double").alias("lon1"),
        (c("l_linenumber") * 20 - 70).cast("double").alias("lat2"), (c("l_partkey") % 360 - 180).cast("double").alias("lon2"))
    at = [c(n) for n in ("lat1", "lon1", "lat2", "lon2")]
    return points.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                         F.round(numeric.haversine(*at), 3).alias("miles"),
                         F.round(numeric.haversine(*at, unit="km"), 3).alias("km"))


@query("sc24_degrees_to_radians", "SELECT l_orderkey, l_linenumber, l_partkey, round(radians(l_quantity * 7), 9) AS rad FROM lineitem")
def _(lake):
    return lake.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                         F.round(F.radians(c("l_quantity") * 7), 9).alias("rad"))


@query("sc25_width_bucket", """SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice >= 420000 THEN 9
ELSE floor((o_totalprice - 100000) / 40000) + 1 END AS BIGINT) AS bucket FROM orders""")
def _(lake):
    return lake.table("orders").select("o_orderkey", numeric.width_bucket(
        c("o_totalprice"), F.lit(100000), F.lit(420000), F.lit(8)).alias("bucket"))


@query("sc26_url_host", """SELECT page_id, url, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host FROM pages""")
def _(lake):
    return lake.table("pages").select("page_id", "url", web.url_host(c("url")).alias("host"))


_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("sc27_url_path", f"""SELECT page_id, url, split_part(right(bare, length(bare) - coalesce(nullif(strpos(bare, '/'), 0), strpos(bare, '?') - 1)), '?', 1) AS path
FROM (SELECT *, {_BARE} AS bare FROM pages)""")
def _(lake):
    return lake.table("pages").select("page_id", "url", web.url_path(c("url")).alias("path"))


@query("sc28_url_parameter", """SELECT page_id, url, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page_no,
nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm FROM pages""")
def _(lake):
    return lake.table("pages").select("page_id", "url", web.url_parameter(c("url"), "page").alias("page_no"),
                                      web.url_parameter(c("url"), "utm_source").alias("utm"))


@query("sc29_arrays", """SELECT l_orderkey, l_linenumber, l_partkey, '[' || l_orderkey || ',' || l_linenumber || ']' AS built,
'[' || l_orderkey || ',' || l_linenumber || ',' || l_partkey || ']' AS appended,
'[' || l_orderkey || ',' || l_linenumber || ',' || l_suppkey || ',' || l_partkey || ']' AS joined, '[]' AS nothing FROM lineitem""")
def _(lake):
    k, n, p, s = (c(x).cast("bigint") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    pair = arrays.array_construct([k, n])
    return lake.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", arrays.array_to_text(pair).alias("built"),
        arrays.array_to_text(arrays.array_append(pair, p)).alias("appended"),
        arrays.array_to_text(arrays.array_concat(pair, arrays.array_construct([s, p]))).alias("joined"),
        arrays.array_to_text(arrays.array_construct([])).alias("nothing"))


@query("sc30_type_names", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS as_string, CAST(o_orderdate AS TIMESTAMP) AS as_timestamp,
CAST(CAST(o_orderkey AS FLOAT) AS DOUBLE) AS as_float, CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS DOUBLE) AS as_numeric,
CAST(o_custkey AS BIGINT) AS as_bigint, CAST(o_custkey AS INTEGER) AS as_int FROM orders""")
def _(lake):
    sources = {"string": "o_custkey", "timestamp": "o_orderdate", "float": "o_orderkey", "numeric": "o_totalprice",
               "bigint": "o_custkey", "int": "o_custkey"}
    casts = {f"as_{t}": c(s).cast(text.type_name(t)) for t, s in sources.items()}
    casts["as_float"] = casts["as_float"].cast("double")
    return lake.table("orders").select("o_orderkey", *[e.alias(n) for n, e in casts.items()])


@query("sc31_slugify", """SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name || ' - ' || p_brand), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS slug FROM part""")
def _(lake):
    return lake.table("part").select("p_partkey", text.slugify_column(F.concat_ws(" - ", "p_name", "p_brand")).alias("slug"))


@query("sc32_arithmetic", """SELECT l_orderkey, l_linenumber, l_partkey, abs(l_quantity - 25) AS distance, pow(l_quantity, 2) AS squared,
l_orderkey % 7 AS rest, CAST(ceil(l_quantity / 7) AS BIGINT) AS up, least(l_quantity, 25) AS capped,
CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 1) AS DOUBLE) AS rounded FROM lineitem""")
def _(lake):
    q = c("l_quantity")
    money = c("l_extendedprice").cast("decimal(12,2)") * c("l_discount").cast("decimal(4,2)")
    return lake.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.abs(q - 25).alias("distance"), F.pow(q, F.lit(2)).alias("squared"),
        (c("l_orderkey") % 7).alias("rest"), F.ceil(q / 7).alias("up"), F.least(q, F.lit(25.0)).alias("capped"),
        F.round(money, 1).cast("double").alias("rounded"))


@query("sc33_date_from_text", f"""SELECT payment_id, CAST({_ANY_SQL} AS DATE) AS day {_PARSE_FROM}""")
def _(lake):
    return lake.bronze("payments").select(c("`payment-id`").alias("payment_id"),
                                          timestamps.date_or_null("payment-date").alias("day"))
