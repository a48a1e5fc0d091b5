"""Refreshing by what changed gives what a full build gives, also after moved keys and broken runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import gold, refresh
from tidemark.registry.layers import staging
from tidemark.sinks import versioned
from tidemark.sources.bronze import Lake


def as_of():
    return F.lit(dt.date(2001, 8, 2))


KEYS = {"customers": "customer_id", "orders": "order_id", "payments": "payment_id", "products": "product_id", "shipments": "tracking_number"}
c = F.col


def collect(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def silver(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    return {e: staging(lake, e) for e in KEYS}


def put(spark, warehouse, entity, df):
    versioned.merge(df, f"{warehouse}/stg_{entity}", [KEYS[entity]], ["ingestion_date"], properties={"newest": 0})


def tables_of(spark, warehouse):
    return {f"stg_{e}": versioned.read(spark, f"{warehouse}/stg_{e}") for e in KEYS}


def refreshed(spark, warehouse):
    return refresh.refresh_gold(spark, tables_of(spark, warehouse), warehouse, as_of(), grain="year")


def assert_full(spark, warehouse, got):
    s = tables_of(spark, warehouse)
    facts = gold.order_facts(s["stg_orders"], s["stg_payments"], s["stg_shipments"]).withColumn("order_date_partition", F.to_date(F.date_trunc("year", "order_date")))
    assert collect(got["order_facts"]) == collect(facts)
    assert collect(got["daily_metrics"]) == collect(gold.daily_metrics(facts))
    profiles = gold.customer_360(s["stg_customers"], facts, as_of())
    assert collect(got["customer_360"]) == collect(profiles)
    assert collect(got["rfm_scores"]) == collect(gold.rfm_scores(profiles))
    assert collect(got["product_catalog"]) == collect(gold.product_catalog(s["stg_products"]))


def test_changes_of_every_kind(spark, scratch, silver, monkeypatch):
    for entity, df in silver.items():
        put(spark, scratch, entity, df.where(c(KEYS[entity]) % 7 != 2) if entity != "customers" else df)
    assert_full(spark, scratch, refreshed(spark, scratch))

    orders, payments = silver["orders"], silver["payments"]
    moved = payments.where(c("payment_id") % 50 == 1).withColumn("order_id", c("order_id") + 1)  # to another order
    put(spark, scratch, "payments", moved.unionByName(payments.where(c("payment_id") % 7 == 2).where(c("payment_id") % 50 != 1)))
    changed = (orders.where(c("order_id") % 20 == 1)
               .withColumn("customer_id", F.when(c("order_id") % 3 == 0, c("customer_id") + 1).otherwise(c("customer_id")))
               .withColumn("order_date", F.when(c("order_id") % 3 == 1, F.timestamp_add("DAY", F.lit(400), c("order_date"))).otherwise(c("order_date")))
               .withColumn("payment_method", F.when(c("order_id") % 3 == 2, F.lit("voucher")).otherwise(c("payment_method"))))
    put(spark, scratch, "orders", changed.unionByName(orders.where((c("order_id") % 7 == 2) & (c("order_id") % 20 != 1))))
    put(spark, scratch, "shipments", silver["shipments"].where(c("tracking_number") % 7 == 2))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):  # a run that stops before the facts are published
        publish = versioned._publish

        def stop(spark_, at):
            if at.path.endswith("order_facts"):
                raise RuntimeError("stopped")
            publish(spark_, at)
        m.setattr(versioned, "_publish", stop)
        refreshed(spark, scratch)
    assert_full(spark, scratch, refreshed(spark, scratch))

    # an order of a customer with many others goes back to what it was, the only change of this batch
    put(spark, scratch, "orders", orders.where(c("order_id") == orders.where(c("order_id") % 60 == 1).agg(F.min("order_id")).first()[0]))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):  # between facts and profiles
        m.setattr(refresh, "refresh_profiles", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        refreshed(spark, scratch)
    assert_full(spark, scratch, refreshed(spark, scratch))
    assert versioned.changes(spark, f"{scratch}/customer_profiles", 2).select("customer_id").distinct().count() <= 2

    numbers = {n: versioned.current(spark, f"{scratch}/{n}").number for n in ("order_facts", "profile_parts", "customer_profiles", "product_catalog")}
    assert_full(spark, scratch, refreshed(spark, scratch))  # nothing new
    assert numbers == {n: versioned.current(spark, f"{scratch}/{n}").number for n in numbers}


def test_a_payment_that_moves_away(spark, scratch, silver):
    for entity, df in silver.items():
        put(spark, scratch, entity, df)
    refreshed(spark, scratch)
    payment = silver["payments"].where("payment_status = 'completed'").orderBy("payment_id").first()
    put(spark, scratch, "payments", silver["payments"].where(c("payment_id") == payment["payment_id"]).withColumn("order_id", c("order_id") + 1))
    assert_full(spark, scratch, refreshed(spark, scratch))


def test_only_admitted_pieces_of_orders_are_read(spark, scratch, silver):
    put(spark, scratch, "orders", silver["orders"].withColumn("ingestion_date", F.to_date(F.date_trunc("year", "order_date"))))
    one = silver["orders"].orderBy("order_id").limit(1).select("order_id")
    found = versioned.rows_of(spark, f"{scratch}/stg_orders", one)
    assert found.count() == 1 and len(found.inputFiles()) < len(versioned.read(spark, f"{scratch}/stg_orders").inputFiles())


def test_parts_are_added_up_in_one_pass(spark):
    parts = "customer_id long, level int, value string, first_use date, latest_use date, uses long, amount long"
    day = [dt.date(2024, 1, n) for n in range(1, 9)]
    old = spark.createDataFrame([(1, 3, None, day[2], day[3], 2, 5), (1, 1, "a", day[2], day[3], 2, None), (2, 3, None, day[1], day[2], 4, 8), (2, 1, "b", day[1], day[2], 4, 8),
                                 (None, 3, None, day[1], day[1], 1, 1)], parts)
    counted = spark.createDataFrame([(1, 3, None, day[1], day[1], 1, 2), (1, 2, "x", None, None, 1, None), (2, 3, None, day[4], day[5], 3, 6)], parts)
    lost = spark.createDataFrame([(2,), (None,)], "customer_id long")
    got = refresh._added_up(old, lost, counted)
    assert got.dtypes == old.dtypes
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 3, None, day[1], day[3], 3, 7), (1, 2, "x", None, None, 1, None), (2, 3, None, day[4], day[5], 3, 6),
                                                                  (2, 1, "b", None, None, 0, None), (None, 3, None, None, None, 0, None)], key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
