"""Sources, sinks, control tables and streams. Queries that write do so in a fresh scratch folder and read the
result back, so that the comparison covers the files."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import aware, utc
from tidemark.operators import checks, joins
from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.filters import newest
from tidemark.plans import refresh, silver
from tidemark.registry.core import BODIES, as_of, query
from tidemark.registry.layers import staging
from tidemark.session import scratch_path
from tidemark.sinks import control, incremental, ingest, landing, periods, versioned
from tidemark.sources import catalog, extract, replies
from tidemark.streaming import tables as streams

c = F.col


def _ts(text: str):
    return F.lit(text).cast("timestamp")


# -- sources -----------------------------------------------------------------------------------------

@query("src1_scan_table", "SELECT * FROM orders")
def _(lake):
    return lake.table("orders")


_SINCE = {"customers": "1998-03-01", "orders": "1998-03-01", "products": "1996-01-01"}


@query("src2_extract_since", " UNION ALL ".join(
    f"SELECT '{e}' AS entity, md5(concat_ws('|', {', '.join(f'CAST({n} AS VARCHAR)' for n in extract.EXTRACTS[e][1] if n in keys)})) AS row_hash, {keys[0]} AS id FROM bronze_{e} "
    f"WHERE {extract.EXTRACTS[e][0]} >= TIMESTAMP '{_SINCE[e]}'"
    for e, keys in {"customers": ["customer_id", "email", "country", "city", "customer_segment"], "orders": ["order_id", "customer_id", "order_status", "payment_method"],
                    "products": ["product_id", "product_name", "category", "brand"]}.items()))
def _(lake):
    """All three entities of the database."""
    keys = {"customers": ["customer_id", "email", "country", "city", "customer_segment"], "orders": ["order_id", "customer_id", "order_status", "payment_method"],
            "products": ["product_id", "product_name", "category", "brand"]}

    def part(e):
        rows = extract.extract(lake.bronze(e), e, _ts(_SINCE[e]))
        assert rows.columns == extract.EXTRACTS[e][1]
        kept = [n for n in extract.EXTRACTS[e][1] if n in keys[e]]
        return rows.select(F.lit(e).alias("entity"), F.md5(F.concat_ws("|", *[c(n).cast("string") for n in kept])).alias("row_hash"), c(keys[e][0]).alias("id"))
    return reduce(DataFrame.unionAll, [part(e) for e in keys])


@query("src3_read_date_partitions", "SELECT event_id, user_id, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'")
def _(lake):
    path = scratch_path(lake.spark, "events")
    events = lake.table("events").select("event_id", "user_id", F.to_date("ts").alias("date"))
    incremental.append_partitions(events, path, ["date"])
    return extract.read_date_partitions(lake.spark, path, "2024-01-05", "2024-01-11")


@query("src4_filter_by_date_range", """SELECT "payment-id" AS payment_id, "payment-date" AS payment_date FROM bronze_payments
WHERE "payment-date" <> '10:00:00' AND CAST(CAST("payment-date" AS TIMESTAMP) AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'""")
def _(lake):
    p = lake.bronze("payments").select(c("`payment-id`").alias("payment_id"), c("`payment-date`").alias("payment_date"))
    return extract.filter_by_date_range(p, "payment_date", F.lit("1998-01-01").cast("date"), F.lit("1998-06-30").cast("date"))


@query("src5_pull_in_chunks", """SELECT event_id, chunk FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d FROM events)
JOIN (SELECT unnest(range(0, 5)) AS chunk) ON d BETWEEN chunk * 7 AND least(chunk * 7 + 7, 29) WHERE d <= 29""")
def _(lake):
    start, end = extract.pull_start(None), _ts("2024-01-30 12:00:00")
    return extract.pull_in_chunks(lake.table("events"), "ts", start, end).select("event_id", c("chunk").cast("bigint").alias("chunk"))


_PULLED_EVENTS = """SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, chunk FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d FROM events)
JOIN (SELECT unnest(range(0, 5)) AS chunk) ON d BETWEEN chunk * 7 AND least(chunk * 7 + 7, 29) WHERE d <= 29"""


def _stored_replies(lake) -> str:
    path = scratch_path(lake.spark, "replies")
    replies.store_replies(lake.table("events").select("event_id", c("ts").cast("timestamp").alias("ts")), path, "events", "ts", extract.pull_start(None), _ts("2024-01-30 12:00:00"))
    return path


@query("src5_data_source", f"SELECT * FROM ({_PULLED_EVENTS}) WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20 06:00:00'")
def _(lake):
    pulled = replies.read_replies(lake.spark, _stored_replies(lake), "event_id bigint, ts timestamp, chunk bigint", "events", "ts")
    return pulled.where((c("ts") >= _ts("2024-01-10")) & (c("ts") < _ts("2024-01-20 06:00:00")))


@query("src5_data_stream", _PULLED_EVENTS)
def _(lake):
    path = scratch_path(lake.spark, "stream")
    stream = replies.stream_replies(lake.spark, _stored_replies(lake), "event_id bigint, ts timestamp, chunk bigint", "events")
    _run(lake, stream, streams.append_to(path))
    return lake.spark.read.parquet(path).select("event_id", "ts", "chunk")


_RECORD = "id BIGINT, status STRING, amount DOUBLE"


@query("src6_unwrap_envelope", """SELECT l_orderkey, l_linenumber AS line, l_partkey AS id, l_returnflag AS status, l_extendedprice AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 'second', l_tax FROM lineitem WHERE l_linenumber IN (1, 2, 3)""")
def _(lake):
    first = F.struct(c("l_partkey").alias("id"), c("l_returnflag").alias("status"), c("l_extendedprice").alias("amount"))
    second = F.struct(c("l_suppkey").alias("id"), F.lit("second").alias("status"), c("l_tax").alias("amount"))
    two = F.array(first, second)
    line = c("l_linenumber")
    page = F.to_json(F.struct(two.alias("payments"), F.lit(False).alias("has_more")))
    reply = (F.when(line == 1, F.to_json(F.struct(page.alias("body")))).when(line == 2, page)
             .when(line == 3, F.to_json(two)).when(line == 4, F.to_json(F.struct(first.alias("payments"))))
             .otherwise(F.to_json(first)))
    replies = lake.table("lineitem").select("l_orderkey", line.alias("line"), reply.alias("reply"))
    return extract.unwrap_envelope(replies, "reply", "payments", _RECORD)


@query("src7_register_landed", "SELECT DATE '2024-01-01' + CAST(day(ts) % 3 AS INTEGER) AS ingestion_date, count(*) AS n_rows FROM events GROUP BY 1")
def _(lake):
    root = scratch_path(lake.spark, "landed")
    events = lake.table("events").withColumn("ingestion_date", F.date_add(F.lit("2024-01-01").cast("date"), F.dayofmonth("ts") % 3))
    incremental.append_partitions(events, f"{root}/events", ["ingestion_date"])
    events.select("event_id").write.parquet(f"{root}/events/tmp/unfinished")  # must not be read
    fresh = extract.register_landed(lake.spark, root, "events", "tidemark_landed_events")
    registered = lake.spark.table("tidemark_landed_events").groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("n_rows"))
    return registered.where(F.concat(F.lit("ingestion_date="), c("ingestion_date").cast("string")).isin(fresh))


@query("src7_catalogue", """SELECT DATE '2024-01-01' + CAST(day(ts) % 3 AS INTEGER) AS ingestion_date, CAST(day(ts) % 3 = 2 AS INTEGER) AS late, count(*) AS n_rows,
count(CASE WHEN day(ts) % 3 = 2 THEN user_id END) AS n_users FROM events GROUP BY 1, 2""")
def _(lake):
    """Two registrations, the second with a new folder and a new column, read from another session on the same catalogue."""
    root = scratch_path(lake.spark, "landed")
    table = "tidemark_" + root.rsplit("-", 1)[1]
    events = lake.table("events").withColumn("ingestion_date", F.date_add(F.lit("2024-01-01").cast("date"), F.dayofmonth("ts") % 3))
    late = F.dayofmonth("ts") % 3 == 2
    incremental.append_partitions(events.where(~late).select("event_id", "ingestion_date"), f"{root}/events", ["ingestion_date"])
    first = catalog.register(lake.spark, root, "events", table)
    incremental.append_partitions(events.where(late).select("event_id", "user_id", "ingestion_date"), f"{root}/events", ["ingestion_date"])
    second = catalog.register(lake.spark, root, "events", table)
    rows = catalog.landed_table(lake.spark.newSession(), table)
    return (rows.withColumn("late", F.concat(F.lit("ingestion_date="), c("ingestion_date").cast("string")).isin(second).cast("int"))
            .where(F.lit(not set(first) & set(second))).groupBy("ingestion_date", "late").agg(F.count("*").alias("n_rows"), F.count("user_id").alias("n_users")))


@query("src8_csv_seed", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(lake):
    path = scratch_path(lake.spark, "seed")
    lake.table("part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.csv(path, header=True)
    return extract.read_seed(lake.spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("src9_load_existing", """SELECT order_item_id, order_id, quantity FROM bronze_order_items WHERE order_id IN
(SELECT order_id FROM bronze_orders WHERE CAST(order_date AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')""")
def _(lake):
    orders = extract.filter_by_date_range(lake.bronze("orders"), "order_date", F.lit("1997-01-01").cast("date"),
                                          F.lit("1997-12-31").cast("date"))
    return joins.matching(lake.bronze("order_items"), "order_id", orders, "order_id").select("order_item_id", "order_id", "quantity")


@query("src10_last_date_and_next_id", "SELECT max(order_date) AS last_order_date, max(order_id) + 1 AS next_id, count(*) > 0 AS has_rows FROM bronze_orders")
def _(lake):
    o = lake.bronze("orders")
    return o.agg(F.max("order_date").alias("last_order_date"), (F.max("order_id") + 1).alias("next_id")).withColumn(
        "has_rows", F.lit(extract.has_rows(o)))


# -- sinks -------------------------------------------------------------------------------------------

_INGESTED = datetime.datetime(2001, 8, 2, 6, 0, 0)
_RECORDS = ["customer_id", "date_of_birth", "email", "first_name", "gender", "last_name", "phone", "city", "country", "customer_segment", "address", "postal_code", "state"]


def _json_sql(columns) -> str:
    return "CAST(to_json({" + ", ".join(f"'{n}': {n}" for n in sorted(columns)) + "}) AS VARCHAR)"


@query("snk1_bronze_metadata", f"""SELECT * EXCLUDE (date_text) REPLACE (CAST(date_text AS DATE) AS date_of_birth), TIMESTAMP '2001-08-02 06:00:00' AS _ingestion_ts, 'rds' AS _source_system,
md5({_json_sql(_RECORDS)}) AS _record_hash FROM (SELECT * REPLACE (strftime(date_of_birth, '%Y-%m-%d') AS date_of_birth), strftime(date_of_birth, '%Y-%m-%d') AS date_text
FROM (SELECT {', '.join(_RECORDS)} FROM bronze_customers))""")
def _(lake):
    """The hash covers every text, number and date of a customer."""
    return landing.add_bronze_metadata(lake.bronze("customers").select(*_RECORDS), _INGESTED, "rds").drop("_ingestion_id")


@query("snk2_coerce_timestamps", """SELECT "payment-id" AS payment_id, "payment-date" AS payment_date, CAST("created-at" AS TIMESTAMP) AS created_at,
CAST("updated-at" AS TIMESTAMP) AS updated_at FROM bronze_payments""")
def _(lake):
    p = lake.bronze("payments")
    return landing.coerce_timestamps(p.select(*[c(f"`{n}`").alias(n.replace("-", "_")) for n in
                                                ("payment-id", "payment-date", "created-at", "updated-at")]))


@query("snk3_batch_event_date", """SELECT 'orders' AS entity, CAST(max(updated_at) AS DATE) AS event_date FROM bronze_orders
UNION ALL SELECT 'events', NULL UNION ALL SELECT 'unshipped', CAST(max(order_date) AS DATE) FROM bronze_orders
UNION ALL SELECT 'shipments', CAST(max(CAST("shipment-date" AS TIMESTAMP)) AS DATE) FROM bronze_shipments""")
def _(lake):
    """The first listed column that holds a date decides; without one there is none."""
    orders = lake.bronze("orders").select("order_id", "order_date", "created_at", "updated_at")
    blank = orders.select("order_id", "order_date", *[F.lit(None).cast("timestamp").alias(n) for n in ("created_at", "updated_at")])
    shipments = lake.bronze("shipments").select(c("`shipment-date`").alias("shipment_date"))
    batches = {"orders": orders, "events": lake.table("events").select("event_id"), "unshipped": blank, "shipments": shipments}
    return reduce(DataFrame.unionAll, [landing.batch_event_date(df).select(F.lit(n).alias("entity"), "event_date") for n, df in batches.items()])


_ODD = """SELECT "payment-id" AS id, "payment-date" AS paid, CASE WHEN "payment-date" <> '10:00:00' THEN CAST("payment-date" AS TIMESTAMP) END AS paid_parsed, 'dated' AS kind, CAST(NULL AS VARCHAR) AS note FROM bronze_payments
UNION ALL SELECT "payment-id", 'junk', NULL, 'junk', NULL FROM bronze_payments
UNION ALL SELECT "payment-id", NULL, NULL, 'dateless', NULL FROM bronze_payments
UNION ALL SELECT "payment-id", "payment-date", CASE WHEN "payment-date" <> '10:00:00' THEN CAST("payment-date" AS TIMESTAMP) END, 'wider', "payment-method" FROM bronze_payments"""


@query("snk4_landing_of_odd_batches", _ODD)
def _(lake):
    """A clean batch, one with unreadable dates, one without dates and one with a column more, read back whole."""
    root = scratch_path(lake.spark, "bronze")
    rows = lake.bronze("payments").select(c("`payment-id`").alias("id"), c("`payment-date`").alias("payment_date"), c("`payment-method`").alias("note"))
    batches = [("dated", rows.drop("note")), ("junk", rows.drop("note").withColumn("payment_date", F.lit("junk"))), ("dateless", rows.select("id")), ("wider", rows)]
    for n, (kind, batch) in enumerate(batches):
        landing.write_to_bronze(root, "payments", batch.withColumn("kind", F.lit(kind)), _INGESTED + datetime.timedelta(days=n), "incremental", "api")
    return extract.read_landed(lake.spark, root, "payments").select("id", c("payment_date_raw").alias("paid"), c("payment_date").alias("paid_parsed"), "kind", "note")


@query("snk4_write_to_bronze", """SELECT order_id, order_status, load_type, CASE load_type WHEN 'full' THEN DATE '2001-08-02' ELSE DATE '2001-08-03' END AS ingestion_date,
max(CAST(updated_at AS DATE)) OVER (PARTITION BY load_type) AS event_date FROM bronze_orders""")
def _(lake):
    root = scratch_path(lake.spark, "bronze")
    rows = lake.bronze("orders").select("order_id", "order_status", "order_date", "updated_at", "load_type")
    full, late = (rows.where(c("load_type") == t).drop("load_type") for t in ("full", "incremental"))
    next_day = _INGESTED + datetime.timedelta(days=1)
    landing.write_to_bronze(root, "orders", late, _INGESTED, "incremental", "rds")  # replaced by the full load
    landing.write_to_bronze(root, "orders", full, _INGESTED, "full", "rds")
    for _ in range(2):  # a repeated batch replaces its own partition
        landing.write_to_bronze(root, "orders", late, next_day, "incremental", "rds")
    return extract.read_landed(lake.spark, root, "orders").select("order_id", "order_status", "load_type", "ingestion_date", "event_date")


@query("snk5_merge_by_key", """SELECT order_id, order_status FROM bronze_orders QUALIFY row_number() OVER (PARTITION BY order_id
ORDER BY CASE load_type WHEN 'incremental' THEN 1 ELSE 0 END DESC, _record_hash DESC) = 1""")
def _(lake):
    o = lake.bronze("orders").select("order_id", "order_status", "_record_hash", "load_type")
    merged = incremental.merge_by_key(o.where("load_type = 'full'"), o.where("load_type = 'incremental'"), "order_id",
                                      [c("_record_hash").desc()])
    return merged.select("order_id", "order_status")


def _day(n: int) -> datetime.date:
    return datetime.date(2024, 1, n)


@query("snk6_update_date_partitions", """SELECT event_id, CASE WHEN event_type = 'error' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
THEN 'fixed' ELSE event_type END AS event_type, CAST(ts AS DATE) AS date FROM events""")
def _(lake):
    path = scratch_path(lake.spark, "events")
    events = lake.table("events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    incremental.update_date_partitions(events, path, "ts", "event_id", _day(1), _day(31))
    fixed = events.where("event_type = 'error'").withColumn("event_type", F.lit("fixed"))
    incremental.update_date_partitions(fixed, path, "ts", "event_id", _day(5), _day(20))
    return lake.spark.read.parquet(path).select("event_id", "event_type", "date")


@query("snk7_append_bounded_files", "SELECT l_returnflag, l_linestatus, count(*) AS n_rows, true AS files_bounded FROM lineitem GROUP BY 1, 2")
def _(lake):
    path = scratch_path(lake.spark, "lines")
    lines = lake.table("lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    incremental.append_partitions(lines, path, ["l_returnflag", "l_linestatus"], gather=False)
    per_file = (lake.spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus", F.input_file_name().alias("file"))
                .agg(F.count(F.lit(1)).alias("n")))
    return per_file.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= incremental.ROWS_PER_FILE).alias("files_bounded"))


@query("snk8_replace_table", "SELECT product_id, product_name, category FROM stg_products")
def _(lake):
    path = scratch_path(lake.spark, "catalog")
    name = "tidemark_" + path.rsplit("-", 1)[1]
    products = staging(lake, "products").select("product_id", "product_name", "category")
    incremental.replace_table(products.select("product_id"), name, path)
    return incremental.replace_table(products, name, path)


_CUT = "1999-01-01 12:00:00"  # between the two deliveries of one batch


@query("snk9_insert_overwrite", f"""SELECT order_id, order_status, ingestion_date FROM (
SELECT * FROM bronze_orders WHERE _ingestion_ts <= TIMESTAMP '{_CUT}' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1)
UNION ALL SELECT order_id, order_status, ingestion_date FROM (
SELECT * FROM bronze_orders WHERE _ingestion_ts > TIMESTAMP '{_CUT}' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1)""")
def _(lake):
    path = scratch_path(lake.spark, "silver-orders")
    source = lake.bronze("orders").select("order_id", "order_status", "_ingestion_ts", "_record_hash", "ingestion_date")
    for rows in (source.where(c("_ingestion_ts") <= _ts(_CUT)), source, source):  # the third run finds nothing new
        incremental.incremental_overwrite(rows, lambda new: latest_per_key(new, ["order_id"]), path, ["ingestion_date"])
    return lake.spark.read.parquet(path).select("order_id", "order_status", "ingestion_date")


@query("snk10_upsert", """SELECT order_id, order_status, payment_status, ingestion_date FROM stg_orders""")
def _(lake):
    path = scratch_path(lake.spark, "silver-orders")
    source = lake.bronze("orders")
    for rows in (source.where(c("_ingestion_ts") <= _ts(_CUT)), source.where(c("_ingestion_ts") > _ts(_CUT))):
        built = silver.stg_orders(rows).select("order_id", "order_status", "payment_status", "ingestion_date")
        incremental.upsert(built, path, ["order_id"], ["ingestion_date"])
    return lake.spark.read.parquet(path).select("order_id", "order_status", "payment_status", "ingestion_date")


@query("snk11_sync_columns", """SELECT customer_id, email, country, CAST(NULL AS VARCHAR) AS gender FROM bronze_customers WHERE load_type = 'full'
UNION ALL SELECT customer_id + 1000000000, email, country, gender FROM bronze_customers WHERE load_type = 'incremental'""")
def _(lake):
    path = scratch_path(lake.spark, "customers")
    cu = lake.bronze("customers")
    incremental.upsert(cu.where("load_type = 'full'").select("customer_id", "email", "country", "phone"), path, ["customer_id"])
    late = cu.where("load_type = 'incremental'").select((c("customer_id") + 1000000000).alias("customer_id"), "email", "country", "gender")
    incremental.upsert(late, path, ["customer_id"])
    return lake.spark.read.parquet(path)


@query("snk12_insert_by_period", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20' - INTERVAL 1 MILLISECOND")
def _(lake):
    path = scratch_path(lake.spark, "periods")
    events = lake.table("events").select("event_id", "ts")
    for stop in (_day(10), _day(20)):  # the second run resumes after the newest stored row
        incremental.insert_by_period(lambda inside: events.where(inside), path, "ts", datetime.datetime(2024, 1, 3),
                                     datetime.datetime(stop.year, stop.month, stop.day), "week", lake.spark)
    return lake.spark.read.parquet(path)


@query("snk10_versioned_merge", """SELECT order_id, order_status, payment_status, ingestion_date FROM stg_orders""")
def _(lake):
    path = scratch_path(lake.spark, "silver-orders")
    source = lake.bronze("orders")
    for rows in (source.where(c("_ingestion_ts") <= _ts(_CUT)), source.where(c("_ingestion_ts") > _ts(_CUT))):
        built = silver.stg_orders(rows).select("order_id", "order_status", "payment_status", "ingestion_date")
        versioned.merge(built, path, ["order_id"], ["ingestion_date"])
    return versioned.read(lake.spark, path)


_LATEST = """SELECT * FROM bronze_orders WHERE {0} QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1"""


@query("snk10_changes", f"""WITH a AS ({_LATEST.format(f"_ingestion_ts <= TIMESTAMP '{_CUT}'")}), b AS ({_LATEST.format(f"_ingestion_ts > TIMESTAMP '{_CUT}'")})
SELECT order_id, lower(order_status) AS order_status, 'after' AS change FROM b
UNION ALL SELECT a.order_id, lower(a.order_status), 'before' FROM a JOIN b ON a.order_id = b.order_id""")
def _(lake):
    """What the second delivery changed, rows before and after."""
    path = scratch_path(lake.spark, "silver-orders")
    source = lake.bronze("orders")
    for rows in (source.where(c("_ingestion_ts") <= _ts(_CUT)), source.where(c("_ingestion_ts") > _ts(_CUT))):
        versioned.merge(silver.stg_orders(rows).select("order_id", "order_status", "ingestion_date"), path, ["order_id"], ["ingestion_date"])
    return versioned.changes(lake.spark, path, 1).select("order_id", "order_status", c(versioned.CHANGE).alias("change"))


@query("snk12_load_periods", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20'")
def _(lake):
    """Weeks, the second run going on where the first stopped inside a week."""
    path = scratch_path(lake.spark, "periods")
    events = lake.table("events").select("event_id", "ts")
    for stop in (_day(12), _day(20)):
        periods.load_periods(lake.spark, lambda inside: events.where(inside), path, "ts", datetime.datetime(2024, 1, 3),
                             datetime.datetime(stop.year, stop.month, stop.day), "week")
    return periods.read_periods(lake.spark, path)


@query("snk13_export_and_reload", """SELECT 'orders' AS table_name, count(*) AS n_rows, (SELECT count(*) FROM (SELECT order_id FROM stg_orders GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys,
(SELECT count(*) FROM stg_orders WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM stg_customers)) AS orphans FROM stg_orders
UNION ALL SELECT 'order_items', count(*), (SELECT count(*) FROM (SELECT order_item_id FROM bronze_order_items GROUP BY 1 HAVING count(*) > 1)),
(SELECT count(*) FROM bronze_order_items WHERE order_id NOT IN (SELECT order_id FROM stg_orders)) FROM bronze_order_items
UNION ALL SELECT 'items_by_product', count(*), (SELECT count(*) FROM (SELECT order_item_id FROM bronze_order_items GROUP BY 1 HAVING count(*) > 1)),
(SELECT count(*) FROM bronze_order_items WHERE product_id NOT IN (SELECT product_id FROM stg_products)) FROM bronze_order_items""")
def _(lake):
    root = scratch_path(lake.spark, "export")
    paths = incremental.export_tables({"customers": staging(lake, "customers"), "orders": staging(lake, "orders"),
                                       "order_items": lake.bronze("order_items"), "products": staging(lake, "products")}, root)
    t = incremental.reload_tables(lake.spark, paths)

    t["items_by_product"] = t["order_items"]

    def report(name, key, column, parent):
        counts = (t[name].agg(F.count(F.lit(1)).alias("n_rows")).withColumns({"duplicate_keys": F.lit(0), "orphans": F.lit(0)})
                  .unionAll(checks.unique(t[name], key).agg(F.count(F.lit(1)).alias("d")).select(F.lit(0), "d", F.lit(0)))
                  .unionAll(checks.orphan_count(t[name], column, t[parent], column).select(F.lit(0), F.lit(0), "failures")))
        return counts.agg(*[F.sum(x).cast("bigint").alias(x) for x in counts.columns]).select(F.lit(name).alias("table_name"), "*")
    return report("orders", "order_id", "customer_id", "customers").unionAll(
        report("order_items", "order_item_id", "order_id", "orders")).unionAll(report("items_by_product", "order_item_id", "product_id", "products"))


@query("snk14_checkpoints", """SELECT entity, last_sync_timestamp, record_count FROM (
SELECT 'customers' AS entity, max(updated_at) AS last_sync_timestamp, count(*) AS record_count FROM bronze_customers
UNION ALL SELECT 'orders', max(updated_at), count(*) FROM bronze_orders UNION ALL SELECT 'products', TIMESTAMP '1970-01-01', NULL)""")
def _(lake):
    path = scratch_path(lake.spark, "checkpoints")
    for entity in ("orders", "customers", "orders"):  # the second sync of an entity replaces the first
        rows = lake.bronze(entity)
        control.update_sync(lake.spark, path, entity, utc(newest(rows, "updated_at")), rows.count(), _INGESTED)
    stored = control.ensure_checkpoints(lake.spark, path).select("entity", "last_sync_timestamp", "record_count")
    missing = control.get_last_sync(lake.spark, path, "products")
    never = stored.limit(0).agg(F.lit("products").alias("entity"), F.lit(aware(missing)).alias("last_sync_timestamp"),
                                F.lit(None).cast("bigint").alias("record_count"))
    return stored.unionByName(never)


_RUNS = """SELECT date_trunc('day', order_date) + INTERVAL 6 HOUR AS run_date, CAST(order_date AS DATE) AS last_processed_date,
CASE WHEN sum(total_amount) < 800000 THEN 'failed' ELSE 'success' END AS status FROM bronze_orders GROUP BY 1, 2"""


@query("snk15_run_log", f"SELECT max_by(last_processed_date, run_date) AS last_processed_date FROM ({_RUNS}) WHERE status = 'success'")
def _(lake):
    path = scratch_path(lake.spark, "runs")
    runs = (lake.bronze("orders").groupBy(F.to_date("order_date").alias("last_processed_date"))
            .agg(F.sum("total_amount").alias("amount"), F.count(F.lit(1)).alias("n")))
    control.append_runs(runs.select(
        F.timestamp_add("HOUR", F.lit(6), c("last_processed_date").cast("timestamp")).alias("run_date"), "last_processed_date",
        F.when(c("amount") < 800000, "failed").otherwise("success").alias("status"),
        F.create_map(F.lit("orders"), c("n")).alias("records_processed"), F.lit(None).cast("string").alias("error_message")), path)
    control.write_run_log(lake.spark, path, datetime.date(2030, 1, 1), "failed", error="no rows", now=_INGESTED)
    return control.last_run_date(lake.spark.read.parquet(path))


@query("snk16_reset", "SELECT load_type, order_id FROM (SELECT 'full' AS load_type, order_id FROM bronze_orders WHERE load_type = 'incremental')")
def _(lake):
    root, path = scratch_path(lake.spark, "bronze"), scratch_path(lake.spark, "checkpoints")
    rows = lake.bronze("orders").select("order_id", "order_date", "updated_at", "load_type")
    for part in ("full", "incremental"):
        batch = rows.where(c("load_type") == part).drop("load_type")
        n = landing.write_to_bronze(root, "orders", batch, _INGESTED, control.load_type(lake.spark, path), "rds")
        control.update_sync(lake.spark, path, "orders", _INGESTED, n, _INGESTED)
        if part == "full":
            control.reset(lake.spark, root, path)
    return extract.read_landed(lake.spark, root, "orders").select("load_type", "order_id")


@query("snk17_load_window", """SELECT CASE WHEN start_date > end_date THEN 'nothing' ELSE 'ongoing' END AS mode, start_date, end_date
FROM (SELECT CAST(max(order_date) AS DATE) + 1 AS start_date, DATE '2001-08-10' - 1 AS end_date FROM bronze_orders)""")
def _(lake):
    no_run = lake.bronze("orders").agg(F.max(F.lit(None).cast("date")).alias("last_processed_date"))
    newest = lake.bronze("orders").agg(F.max("order_date").alias("order_date"))
    return control.load_window(no_run, newest, F.lit("2001-08-10").cast("date"), F.lit("1995-01-01").cast("date"))


# -- whole runs ---------------------------------------------------------------------------------------

def _land(lake, root: str, delivered, load_type: str, entities=tuple(refresh.ENTITIES)) -> None:
    """Lands the commerce tables with the audit columns the projections already carry."""
    for entity in entities:
        rows = lake.bronze(entity).where(delivered).withColumn("load_type", F.lit(load_type))
        incremental.append_partitions(rows, f"{root}/{entity}", ["ingestion_date", "load_type"], gather=False)  # one folder a year and version


@query("run1_refresh_in_two_batches", """SELECT customer_id, email, last_order_date, total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue,
preferred_payment_method, preferred_shipping_carrier FROM customer_360""")
def _(lake):
    bronze, warehouse = scratch_path(lake.spark, "bronze"), scratch_path(lake.spark, "warehouse")
    early = c("_ingestion_ts") <= _ts(_CUT)
    for delivered, load_type in ((early, "full"), (~early, "incremental")):
        _land(lake, bronze, delivered, load_type)
        tables = refresh.refresh(lake.spark, bronze, warehouse, as_of(), grain="year")
    return tables["customer_360"].select("customer_id", "email", "last_order_date", "total_orders", "total_revenue",
                                         "preferred_payment_method", "preferred_shipping_carrier")


_WAREHOUSES: dict[str, tuple] = {}


def _after_three_batches(lake) -> dict:
    """The ten tables after an initial load, then late customers, orders and products, then late payments and shipments.

    The payments and shipments of the third batch are stamped like the orders of the second. Run once per folder and session.
    """
    key, owner = lake.star.folder, lake.spark.sparkContext.applicationId
    if _WAREHOUSES.get(key, (None,))[0] != owner:
        bronze, warehouse = scratch_path(lake.spark, "bronze"), scratch_path(lake.spark, "warehouse")
        early, second = c("_ingestion_ts") <= _ts(_CUT), ("customers", "orders", "products")
        for entities, delivered, load_type in ((refresh.ENTITIES, early, "full"), (second, ~early, "incremental"),
                                               (("payments", "shipments"), ~early, "incremental")):
            _land(lake, bronze, delivered, load_type, entities)
            tables = refresh.refresh(lake.spark, bronze, warehouse, as_of(), grain="year")
        _WAREHOUSES[key] = owner, tables
    return _WAREHOUSES[key][1]


#: The queries that build each table in full, and the columns compared where some only say how a row was written.
_FULL = {"stg_customers": "stg1_stg_customers", "stg_orders": "stg2_stg_orders", "stg_payments": "stg3_stg_payments", "stg_products": "stg4_stg_products",
         "stg_shipments": "stg5_stg_shipments", "order_facts": "gld1_order_facts", "daily_metrics": "gld2_daily_metrics", "customer_360": "gld3_customer_360",
         "rfm_scores": "gld4_rfm_scores", "product_catalog": "gld5_product_catalog"}
_COMPARED = {"order_facts": "order_id, customer_id, order_date, order_status, payment_status, payment_method, payment_amount, payment_date, shipment_status, "
                            "shipping_carrier, tracking_number, shipment_date, estimated_delivery_date, actual_delivery_date, subtotal, discount_amount, tax_amount, "
                            "shipping_cost, total_amount, _ingestion_ts_orders"}

for _name, _query in _FULL.items():
    _columns = _COMPARED.get(_name, "*")
    query(f"run1_{_name}", f"SELECT {_columns} FROM ({BODIES[_query]})")(
        lambda lake, name=_name, columns=_columns: _after_three_batches(lake)[name].selectExpr(*columns.split(", ")))


_PULLED = """SELECT '{0}', 'full', count(DISTINCT id) FROM (SELECT {1} AS id FROM bronze_{0} WHERE CAST(CAST({2} AS TIMESTAMP) AS DATE) <= DATE '1997-01-01')
UNION ALL SELECT '{0}', 'incremental', count(DISTINCT id) FROM (SELECT {1} AS id FROM bronze_{0} WHERE CAST(CAST({2} AS TIMESTAMP) AS DATE) BETWEEN DATE '1997-01-01' AND DATE '2001-08-02') HAVING count(*) > 0"""
_KEPT = """SELECT '{0}', 'full', count(DISTINCT {1}) FROM bronze_{0}
UNION ALL SELECT '{0}', 'incremental', count(DISTINCT {1}) FROM bronze_{0} WHERE {2} >= TIMESTAMP '1997-01-01' HAVING count(*) > 0"""
_API = {"payments": ("payment-id", "`payment-id` BIGINT, `order-id` BIGINT, `amount` DOUBLE, `payment-status` STRING, `updated-at` STRING"),
        "shipments": ("tracking_number", "tracking_number BIGINT, order_id BIGINT, status STRING, `updated-at` STRING")}


@query("run2_ingest_entities", "SELECT entity, load_type, n_rows, 'success' AS status FROM (SELECT NULL AS entity, NULL AS load_type, NULL AS n_rows WHERE false UNION ALL " + " UNION ALL ".join(
    [_KEPT.format(e, k, t) for e, k, t in (("customers", "customer_id", "updated_at"), ("orders", "order_id", "updated_at"), ("products", "product_id", "created_at"))]
    + [_PULLED.format("payments", '"payment-id"', '"updated-at"'), _PULLED.format("shipments", "tracking_number", '"updated-at"')]) + ")")
def _(lake):
    """Two runs over all five entities, three read from the database and two pulled as API replies, with run log and load window."""
    spark = lake.spark
    bronze, checkpoints, runs = (scratch_path(spark, n) for n in ("bronze", "checkpoints", "runs"))

    def replies(entity, record):
        """What the API answers for a window: one reply per row, in the envelope of the service."""
        columns = [x.split()[0] for x in record.split(", ")]
        rows = lake.bronze(entity).select(*[c(n) for n in columns]).withColumn("at", c("`updated-at`").cast("timestamp"))
        one = F.struct(*[c(n) for n in columns])
        return rows.select("at", F.to_json(F.struct(F.array(one).alias(entity), F.lit(False).alias("has_more"))).alias("reply"))

    def pulled(entity, record, end):
        return lambda since: extract.read_api(lambda start, stop: extract.pull_in_chunks(replies(entity, record), "at", start, stop).select("chunk", "reply"),
                                              entity, record, F.lit(aware(max(since, datetime.datetime(1990, 1, 1)))), F.lit(aware(end)))
    for n, started in enumerate((datetime.datetime(1997, 1, 1), datetime.datetime(2001, 8, 2))):
        readers = {e: lambda since, e=e: extract.extract(lake.bronze(e), e, F.lit(aware(since))) for e in ("customers", "orders", "products")}
        readers |= {e: pulled(e, record, started) for e, (_, record) in _API.items()}
        window = control.load_window(control.last_run_date(control.read_runs(spark, runs)), lake.bronze("orders").agg(F.max(F.lit(None).cast("date")).alias("d")),
                                     F.lit(started.date()), F.lit("1990-01-01").cast("date")).first()
        assert window["mode"] == ("ongoing" if n else "initial")
        ingest.ingest(spark, readers, bronze, checkpoints, started, run_log=runs)
    ids = {"customers": "customer_id", "orders": "order_id", "products": "product_id", **{e: k for e, (k, _) in _API.items()}}
    status = control.read_runs(spark, runs).agg(F.max_by("status", "run_date").alias("status"))
    landed = [extract.read_landed(spark, bronze, e).groupBy("load_type").agg(F.count_distinct(c(f"`{k}`")).alias("n_rows"))
              .select(F.lit(e).alias("entity"), "load_type", "n_rows") for e, k in ids.items()]
    return reduce(DataFrame.unionAll, landed).join(status)


# -- streams -----------------------------------------------------------------------------------------

def _deliveries(lake, df, files: int, name: str):
    """A file stream of ``df`` in files of mixed rows, each of them a micro-batch of its own."""
    folder = scratch_path(lake.spark, name)
    df.repartition(files, F.xxhash64(*df.columns)).write.parquet(folder)
    return streams.file_stream(lake.spark, folder, df.schema, "*.parquet", files_per_batch=1)


def _run(lake, stream, write) -> None:
    checkpoint = scratch_path(lake.spark, "stream-checkpoint")
    for _ in range(2):  # the second pass finds no new files
        streams.available_now(stream, checkpoint, write).awaitTermination()


@query("str1_stream_deduplicated", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(lake):
    lines = lake.table("lineitem").select("l_orderkey", "l_linenumber", c("l_shipdate").cast("timestamp").alias("shipped"))
    again = lines.where("l_linenumber < 3").withColumn("shipped", F.timestamp_add("DAY", F.lit(400), c("shipped")))  # every key of them twice
    path = scratch_path(lake.spark, "stream")
    _run(lake, _deliveries(lake, lines.unionAll(again), 4, "deliveries"), streams.new_keys_to(path, ["l_orderkey", "l_linenumber"]))
    return lake.spark.read.parquet(path).select("l_orderkey", "l_linenumber")


@query("str1_stream_keyed_state", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(lake):
    lines = lake.table("lineitem").select("l_orderkey", "l_linenumber", c("l_shipdate").cast("timestamp").alias("shipped"))
    again = lines.where("l_linenumber < 3").withColumn("shipped", F.timestamp_add("DAY", F.lit(400), c("shipped")))  # every key of them twice
    path = scratch_path(lake.spark, "stream")
    streams.keep_state_on_disk(lake.spark)
    _run(lake, streams.first_of_each(_deliveries(lake, lines.unionAll(again), 4, "deliveries"), ["l_orderkey", "l_linenumber"]), streams.append_to(path))
    return lake.spark.read.parquet(path).select("l_orderkey", "l_linenumber")


@query("str2_stream_daily_windows", """SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amount
FROM events GROUP BY 1""")
def _(lake):
    events = lake.table("events").select("event_id", "ts", c("value").cast("decimal(12,2)").alias("value"))
    path = scratch_path(lake.spark, "stream")
    _run(lake, _deliveries(lake, events, 3, "deliveries"), streams.daily_parts_to(path, "ts", "value"))
    return streams.daily_totals(lake.spark.read.parquet(path))


@query("str3_stream_upsert", """SELECT order_id, order_status FROM bronze_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1""")
def _(lake):
    path = scratch_path(lake.spark, "stream-orders")
    version = F.concat_ws(" ", F.date_format("_ingestion_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "_record_hash")
    versions = lake.bronze("orders").select("order_id", "order_status", version.alias("version"))
    _run(lake, _deliveries(lake, versions, 3, "deliveries"), streams.latest_to(path, ["order_id"], "version", ["order_status"]))
    return lake.spark.read.parquet(path).select("order_id", "order_status")


@query("str3_stream_versioned_merge", """SELECT order_id, order_status FROM bronze_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts DESC, _record_hash DESC) = 1""")
def _(lake):
    path = scratch_path(lake.spark, "stream-orders")
    version = F.concat_ws(" ", F.date_format("_ingestion_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "_record_hash")
    versions = lake.bronze("orders").select("order_id", "order_status", version.alias("version"))
    _run(lake, _deliveries(lake, versions, 3, "deliveries"), streams.merged_to(path, ["order_id"], "version", ["order_status"]))
    return versioned.read(lake.spark, path).select("order_id", "order_status")
