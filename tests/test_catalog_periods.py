"""Catalogue tables over landed folders, period loads that stop halfway, keyed streams, mergeable sets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import gold
from tidemark.sinks import files, periods, versioned
from tidemark.sources import catalog
from tidemark.streaming import tables as streams

c = F.col


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(scratch):
    return "tidemark_t_" + scratch.rsplit("-", 1)[1]


def test_only_new_folders_are_registered(spark, scratch, table):
    land = lambda rows, schema: spark.createDataFrame(rows, schema).write.mode("append").partitionBy("ingestion_date", "load_type").parquet(f"{scratch}/orders")
    land([(1, "a", "2024-01-01", "full"), (2, "b", "2024-01-02", "it's / odd")], "id int, v string, ingestion_date string, load_type string")
    assert len(catalog.register(spark, scratch, "orders", table)) == 2
    assert catalog.register(spark, scratch, "orders", table) == []
    spark.range(3).write.parquet(f"{scratch}/orders/tmp/unfinished")
    files.publish_text(spark, f"{scratch}/orders/ingestion_date=2024-01-01/load_type=full/x.manifest", "no data")
    land([(3, "c", 7, "2024-01-03", "full")], "id int, v string, added int, ingestion_date string, load_type string")
    assert catalog.register(spark, scratch, "orders", table) == ["ingestion_date=2024-01-03/load_type=full"]
    other = spark.newSession()
    assert collect(catalog.landed_table(other, table).select("id", "v", "added", "ingestion_date", "load_type")) == [
        (1, "a", None, dt.date(2024, 1, 1), "full"), (2, "b", None, dt.date(2024, 1, 2), "it's / odd"), (3, "c", 7, dt.date(2024, 1, 3), "full")]
    assert len(catalog.known_partitions(other, table)) == 3 and catalog.register(other, scratch, "orders", table) == []
    plan = catalog.landed_table(other, table).where("ingestion_date = date'2024-01-03'")
    assert plan.count() == 1 and "ingestion_date" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]


def test_folders_that_went(spark, scratch, table):
    write = lambda day: spark.range(2).withColumn("ingestion_date", F.lit(day)).write.mode("append").partitionBy("ingestion_date").parquet(f"{scratch}/e")
    write("2024-01-01")
    write("2024-01-02")
    catalog.register(spark, scratch, "e", table)
    files.delete(spark, f"{scratch}/e/ingestion_date=2024-01-01")
    assert catalog.deregister_missing(spark, scratch, "e", table) == ["ingestion_date=2024-01-01"]
    assert collect(spark.table(table).select("id")) == [(0,), (1,)]


def events(spark, days):
    return spark.createDataFrame([(n, dt.datetime(2024, 1, 1) + dt.timedelta(hours=12 * n)) for n in range(2 * days)], "id int, at timestamp")


D = lambda day: dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


@pytest.mark.parametrize("owner, step", [(periods, "_record"), (files, "publish_text")])
def test_a_run_that_stops_inside_a_period(spark, scratch, monkeypatch, owner, step):
    df = events(spark, 30)
    load = lambda stop: periods.load_periods(spark, lambda inside: df.where(inside), scratch, "at", D(0), D(stop), "week")
    assert load(14) == [dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 8, tzinfo=dt.timezone.utc)]
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(owner, step, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))  # the rows of the third week are there, its record is not
        load(28)
    assert collect(periods.read_periods(spark, scratch).select("id")) == [(n,) for n in sorted(range(28), key=lambda n: repr((n,)))]
    assert len(load(28)) == 2 and load(28) == []
    got = periods.read_periods(spark, scratch)
    assert got.count() == 56 == got.select("id").distinct().count()


def test_an_open_period_is_loaded_again(spark, scratch):
    df = events(spark, 30)
    load = lambda stop: periods.load_periods(spark, lambda inside: df.where(inside), scratch, "at", D(0), stop, "month")
    assert len(load(D(10))) == 1 and periods.read_periods(spark, scratch).count() == 20
    assert len(load(D(20))) == 1 and periods.read_periods(spark, scratch).count() == 40
    assert load(D(15)) == [] and periods.read_periods(spark, scratch).count() == 40
    assert len(load(D(40))) == 2 and periods.read_periods(spark, scratch).count() == 60


def test_periods_without_rows(spark, scratch):
    assert periods.read_periods(spark, scratch) is None
    df = events(spark, 3)
    loaded = periods.load_periods(spark, lambda inside: df.where(inside), scratch, "at", D(50), D(60), "day")
    assert len(loaded) == 10 and periods.read_periods(spark, scratch).count() == 0


def test_keyed_stream_survives_a_restart_and_never_reads_its_table(spark, scratch):
    streams.keep_state_on_disk(spark)
    source, out, batches = f"{scratch}/in", f"{scratch}/out", []

    def write(batch, n):
        batches.append(batch._jdf.queryExecution().toString())
        streams.append_to(out)(batch, n)

    def run():
        stream = streams.first_of_each(streams.file_stream(spark, source, "k int, v int", files_per_batch=1), ["k"])
        streams.available_now(stream, f"{scratch}/cp", write).awaitTermination()
    for n in range(4):
        spark.createDataFrame([(k, n) for k in range(n, 5)], "k int, v int").coalesce(1).write.mode("append").parquet(source)
        if n in (1, 3):
            run()  # a new query on the same checkpoint
    assert collect(spark.read.parquet(out).select("k")) == [(k,) for k in range(5)]
    assert batches and all(out not in plan for plan in batches)


def test_a_repeated_batch_changes_nothing(spark, scratch):
    write = streams.merged_to(scratch, ["k"], "n", ["part"])
    rows = lambda *r: spark.createDataFrame(list(r), "k int, n int, part string")
    batches = [rows((1, 2, "a"), (1, 1, "b"), (2, 1, "a")), rows((1, 1, "c"), (2, 5, "c"), (3, None, "a")), rows((3, 1, "b"))]
    for n, batch in enumerate(batches):
        write(batch, n)
        write(batch, n)
    assert collect(versioned.read(spark, scratch)) == [(1, 2, "a"), (2, 5, "c"), (3, 1, "b")]


def test_order_sets_count_each_order_once(spark):
    schema = "order_id long, order_date timestamp, payment_status string, shipment_status string, actual_delivery_date timestamp"
    rows = [(n, D(n % 40), "completed" if n % 2 else "pending", "delivered" if n % 3 == 0 else None, D(50) if n % 7 == 0 else None) for n in [*range(-50, 400), 10**12, 32768, 32767]]
    rows += [(None, D(1), "completed", None, None), (5000, None, "completed", None, None), (6000, D(1), None, None, None)]
    df = spark.createDataFrame(rows, schema)
    sets = gold.merged_order_sets(gold.daily_order_sets(df.union(df)).unionByName(gold.daily_order_sets(df.where("order_id > 100"))), c("day"))
    want = {}
    for i, at, pay, ship, done in rows:
        if i is not None and at is not None:
            own = want.setdefault(at.date(), (set(), set(), set()))
            for s, holds in zip(own, (True, pay == "completed", ship == "delivered" or done is not None)):
                if holds:
                    s.add(i)
    assert collect(gold.distinct_orders(sets, "day").select("day", "total_orders", "paid_orders", "delivered_orders")) == sorted(
        ((d, *map(len, s)) for d, s in want.items()), key=repr)
    month = gold.merged_order_sets(sets, F.to_date(F.date_trunc("month", "day")).alias("month"))
    assert sum(r.total_orders for r in gold.distinct_orders(month, "month").collect()) == 454


