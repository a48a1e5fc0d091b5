"""Extracts, envelopes, rules, gold invariants and streams on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import gold, rules, silver
from tidemark.sources import extract
from tidemark.sources.bronze import Lake
from tidemark.streaming import tables as streams

c = F.col
D = dt.datetime


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_extract_is_inclusive_and_projects(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    edge = lake.bronze("customers").agg(F.max("updated_at")).first()[0]
    rows = extract.extract(lake.bronze("customers"), "customers", F.lit(edge))
    assert rows.count() >= 1 and "_record_hash" not in rows.columns
    with pytest.raises(ValueError):
        extract.extract(lake.bronze("customers"), "visitors")


def test_chunks(spark):
    start, end = F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 20))
    chunks = extract.chunk_bounds(spark, start, end).orderBy("chunk").collect()
    assert [(r["chunk_start"].day, r["chunk_end"].day) for r in chunks] == [(1, 8), (8, 15), (15, 20)]
    days = spark.createDataFrame([(n, D(2024, 1, n, 12)) for n in (1, 7, 8, 15, 20, 21)], "n int, at timestamp")
    assert collect(extract.pull_in_chunks(days, "at", start, end).select("n", "chunk")) == [
        (1, 0), (15, 1), (15, 2), (20, 2), (7, 0), (8, 0), (8, 1)]
    starts = spark.range(1).select(extract.pull_start("2024-02-03T04:00:00"), extract.pull_start("junk"), extract.pull_start(None)).first()
    assert tuple(starts) == (D(2024, 2, 3, 4), D(2024, 1, 1), D(2024, 1, 1))


def test_pull_in_chunks_matches_bounds(spark):
    start, end = F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 15))  # the last border has no following chunk
    days = spark.createDataFrame([(n, D(2024, 1, n)) for n in range(1, 17)], "n int, at timestamp")
    bounds = extract.chunk_bounds(spark, start, end)
    want = days.join(bounds, F.to_date("at").between(F.to_date("chunk_start"), F.to_date("chunk_end")))
    assert collect(extract.pull_in_chunks(days, "at", start, end).select("n", "chunk")) == collect(want.select("n", "chunk"))


def test_envelopes(spark):
    record = '{"id": 1, "status": "ok"}'
    shapes = ['{"body": "{\\"payments\\": [{\\"id\\": 1, \\"status\\": \\"ok\\"}], \\"has_more\\": false}"}', '{"payments": [%s, %s]}' % (record, record),
              "[%s]" % record, '{"payments": %s}' % record, record, '{"payments": []}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, reply string")
    got = extract.unwrap_envelope(df, "reply", "payments", "id INT, status STRING")
    assert collect(got) == [(0, 1, "ok"), (1, 1, "ok"), (1, 1, "ok"), (2, 1, "ok"), (3, 1, "ok"), (4, 1, "ok")]
    bad = spark.createDataFrame([(0, '{"error": "denied"}')], "i int, reply string")
    with pytest.raises(Exception, match="unexpected reply"):
        extract.unwrap_envelope(bad, "reply", "payments", "id INT").collect()


def test_usual_replies_are_parsed_once_and_odd_ones_read_the_same(spark, monkeypatch):
    records = ['{"id": 1, "status": "ok"}', '{"id": "x", "status": "ok"}', '{"id": 2}', '{"id": 3, "status": 1.50}', '{"id": 4, "status": "1.50"}', '{"id": 5, "status": {"a": 1.0}}',
               '{"id": 6.0, "status": "ok"}', '{"id": 7, "status": null}', "null"]
    shapes = [s % r for r in records for s in ('{"payments": [%s]}', '{"payments": [{"id": 9, "status": "ok"}, %s]}', '{"payments": %s, "body": null}', '[{"payments": [%s]}]')]
    shapes += ['{"payments": [%s], "body": "[]"}' % records[0], '  {"payments": [%s]} ' % records[0]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, reply string")

    def got():
        return extract.unwrap_envelope(df, "reply", "payments", "id INT, status STRING")
    once = collect(got().selectExpr("i", "id", "coalesce(status, 'none') as status").na.fill(-1))
    assert "StructField(body,StringType" in got()._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(extract, "_PLAIN", ())  # every reply the long way
    assert once == collect(got().selectExpr("i", "id", "coalesce(status, 'none') as status").na.fill(-1))


def test_date_partitions_are_pruned(spark, scratch):
    assert extract.read_date_partitions(spark, scratch, "2024-01-01", "2024-01-02") is None
    spark.range(10).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), c("id").cast("int"))).write.partitionBy("date").parquet(scratch)
    df = extract.read_date_partitions(spark, scratch, "2024-01-03", "2024-01-04")
    assert collect(df.select("id")) == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(date" in df._jdf.queryExecution().executedPlan().toString()


def test_new_folders_only(spark, scratch):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, ingestion_date string")
    df.write.partitionBy("ingestion_date").parquet(f"{scratch}/orders")
    assert extract.register_landed(spark, scratch, "orders", "tidemark_new") == ["ingestion_date=2024-01-01", "ingestion_date=2024-01-02"]
    assert extract.register_landed(spark, scratch, "orders", "tidemark_new", {"ingestion_date=2024-01-01", "ingestion_date=2024-01-02"}) == []
    assert spark.table("tidemark_new").count() == 2


def test_customer_flags(spark):
    schema = ("customer_id int, first_name string, last_name string, email string, phone string, country string, city string, state string, "
              "postal_code string, address string, signup_date timestamp, created_at timestamp, updated_at timestamp, customer_segment string, "
              "date_of_birth date, gender string, _ingestion_ts timestamp, _source_system string, _record_hash string, ingestion_date date")

    def row(i, email, phone, born, at=D(2024, 1, 1)):
        return (i, "a", "b", email, phone) + (None,) * 9 + (born, None, at, "rds", "h", at.date())
    df = spark.createDataFrame([
        row(1, " A.B@Ex.COM ", None, dt.date(1983, 8, 3)), row(2, "broken@x", " ", None), row(3, None, "1", dt.date(1983, 8, 2)),
        row(3, "old@x.org", None, None, D(2023, 1, 1)), row(4, None, None, None)], schema)
    out = silver.stg_customers(df, F.lit(dt.date(2001, 8, 2))).select("customer_id", "email", "is_valid_email", "is_adult", "has_contact")
    assert collect(out) == [(1, "a.b@ex.com", True, False, True), (2, "broken@x", False, None, True),
                            (3, None, False, True, True), (4, None, False, None, False)]


def test_order_facts_prefers_completed_then_latest(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    o, p, s = (silver.STAGING[e](lake.bronze(e)) for e in ("orders", "payments", "shipments"))
    facts = gold.order_facts(o, p, s)
    assert facts.count() == o.count() == facts.select("order_id").distinct().count()
    assert facts.agg(F.sum("total_amount")).first() == o.agg(F.sum("total_amount")).first()
    best = gold.best_payment(p)
    worse = p.alias("p").join(best.alias("b"), "order_id").where("p.payment_status = 'completed' and b.payment_status <> 'completed'")
    assert worse.isEmpty()


def test_customers_without_orders_are_kept(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    o, p, s = (silver.STAGING[e](lake.bronze(e)) for e in ("orders", "payments", "shipments"))
    profiles = gold.customer_360(silver.stg_customers(lake.bronze("customers")), gold.order_facts(o, p, s), F.lit(dt.date(2001, 8, 2)))
    empty = profiles.where("total_orders = 0")
    assert not empty.isEmpty()
    assert empty.where("total_revenue <> 0 or avg_order_value <> 0 or last_order_date is not null").isEmpty()


ORDER = ("order_id int, order_date timestamp, order_status string, payment_status string, shipment_date timestamp, delivered_date timestamp, "
         "updated_at timestamp")


def test_order_progress(spark):
    now, old = D(2024, 1, 20), D(2024, 1, 1)
    rows = [(1, D(2024, 1, 19), "processing", "completed", None, None, old), (2, D(2024, 1, 19, 12), "processing", "completed", None, None, old),
            (3, D(2024, 1, 11), "shipped", "completed", D(2024, 1, 12), None, old), (4, D(2024, 1, 12), "shipped", "completed", None, None, old),
            (5, old, "delivered", "completed", None, D(2024, 1, 15), old), (6, old, "delivered", "completed", None, D(2024, 1, 16), old),
            (7, old, "cancelled", "failed", None, None, old), (8, old, "refunded", "refunded", None, None, old)]
    df = spark.createDataFrame(rows, ORDER)
    refunds = spark.createDataFrame([(5,), (6,), (7,)], "order_id int")
    got = {r["order_id"]: r for r in rules.progress_orders(df, F.lit(now), refunds).collect()}
    status = {i: (r["order_status"], r["updated_at"] == now) for i, r in got.items()}
    assert status == {1: ("shipped", True), 2: ("processing", False), 3: ("delivered", True), 4: ("shipped", False),
                      5: ("refunded", True), 6: ("delivered", False), 7: ("cancelled", False), 8: ("refunded", False)}
    assert got[1]["shipment_date"] == D(2024, 1, 20) and got[3]["delivered_date"] == D(2024, 1, 20)
    assert got[5]["payment_status"] == "refunded"


def test_segments(spark):
    now = D(2024, 12, 31)
    customers = spark.createDataFrame([(i, s, "Regular", D(2024, 1, 1)) for i, s in
                                       [(1, D(2024, 12, 1)), (2, D(2024, 1, 1)), (3, D(2024, 1, 1)), (4, D(2024, 1, 1)), (5, D(2024, 12, 30))]],
                                      "customer_id int, signup_date timestamp, customer_segment string, updated_at timestamp")
    orders = spark.createDataFrame([(1, D(2024, 12, 2), 9000), (1, D(2024, 12, 3), 1), (2, D(2024, 12, 2), 9000), (3, D(2024, 12, 2), 6000),
                                    (3, D(2024, 1, 2), 9000), (4, D(2024, 12, 2), 6000), (4, D(2024, 12, 3), 1)],
                                   "customer_id int, order_date timestamp, total_amount int")
    subscribers = spark.createDataFrame([(5,)], "customer_id int")
    out = rules.update_customer_segments(customers, orders, subscribers, F.lit(now))
    got = {r["customer_id"]: (r["customer_segment"], r["updated_at"] == now) for r in out.collect()}
    assert got == {1: ("New", True), 2: ("New", True), 3: ("Regular", False), 4: ("VIP", True), 5: ("VIP", True)}


def test_tracking_codes_and_bands(spark):
    df = spark.createDataFrame([("UPS", 1), ("FedEx", 1), ("DHL", 1)], "carrier string, n bigint")
    codes = [r[0] for r in df.select(rules.tracking_code(c("carrier"), c("n"))).collect()]
    assert len(codes[0]) == 14 and codes[0].startswith("1Z") and len(codes[1].split(" ")) == 3 and len(codes[2]) == 12
    band = lambda days: spark.range(1).select(rules.overdue_band(F.lit(D(2024, 1, 1)), F.lit(None).cast("timestamp"),
                                                                 F.lit(D(2024, 1, 6) + dt.timedelta(days=days)))).first()[0]
    assert [band(n) for n in (0, 2, 3, 4, 5, 7, 8)] == ["on_time", "on_time", "over_2_days", "over_2_days", "over_4_days", "over_4_days", "over_7_days"]


def test_pricing_rounds_each_step(spark):
    df = spark.createDataFrame([(1, 10.05, "Regular", "Canada", 1.0)], "order_id int, s double, segment string, country string, c double").select(
        "order_id", c("s").cast("decimal(18,2)").alias("subtotal"), "segment", "country", c("c").cast("decimal(12,2)").alias("shipping_cost"))
    r = rules.price_orders(df, F.lit(True)).first()
    assert [str(r[x]) for x in ("discount_amount", "tax_amount", "total_amount")] == ["0.50", "1.24", "11.79"]


def test_stream_windows_close_and_drop_late_rows(spark, scratch):
    source, out = f"{scratch}/in", f"{scratch}/out"

    def deliver(*rows):
        spark.createDataFrame(list(rows), "at timestamp, v int").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = streams.file_stream(spark, source, "at timestamp, v int", files_per_batch=1)
        streams.available_now(streams.daily_windows(stream, "at", "v", "2 days"), f"{scratch}/cp", streams.append_to(out)).awaitTermination()
        return collect(spark.read.schema("day date, n_rows bigint, amount bigint").parquet(out).drop("batch"))
    deliver((D(2024, 1, 1, 5), 1), (D(2024, 1, 1, 6), 2), (D(2024, 1, 2), 5))
    assert run() == []
    deliver((D(2024, 1, 1, 7), 4), (D(2024, 1, 6), 1))  # in time, then the watermark moves to the 4th
    assert run() == [(dt.date(2024, 1, 1), 3, 7), (dt.date(2024, 1, 2), 1, 5)]
    deliver((D(2024, 1, 1, 8), 100), (D(2024, 1, 7), 1))  # too late: the day is closed
    assert run() == [(dt.date(2024, 1, 1), 3, 7), (dt.date(2024, 1, 2), 1, 5)]


def test_stream_deduplicates_across_batches(spark, scratch):
    source, out = f"{scratch}/in", f"{scratch}/out"
    schema = "k int, at timestamp"
    for n in range(2):
        spark.createDataFrame([(1, D(2024, 1, 1)), (2 + n, D(2024, 1, 1, n))], schema).coalesce(1).write.mode("append").parquet(source)
        stream = streams.deduplicated(streams.file_stream(spark, source, schema), ["k"], "at", "1 day")
        streams.available_now(stream, f"{scratch}/cp", streams.append_to(out)).awaitTermination()
    assert collect(spark.read.parquet(out).select("k")) == [(1,), (2,), (3,)]
