"""Incremental writes: repeated runs, late batches, moved keys."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest_per_key
from tidemark.sinks import control, files, incremental, landing
from tidemark.sources import extract

c = F.col
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def orders(spark, rows):
    return spark.createDataFrame(rows, "order_id int, status string, day date, _ingestion_ts timestamp, _record_hash string")


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_insert_overwrite_loses_unchanged_rows_of_a_touched_day(spark, scratch):
    first = orders(spark, [(1, "new", D1, T1, "a"), (2, "new", D1, T1, "b"), (3, "new", D2, T1, "c")])
    late = first.unionByName(orders(spark, [(1, "paid", D1, T2, "d")]))
    build = lambda new: latest_per_key(new, ["order_id"])
    incremental.incremental_overwrite(first, build, scratch, ["day"])
    incremental.incremental_overwrite(late, build, scratch, ["day"])
    assert collect(spark.read.parquet(scratch).select("order_id", "status")) == [(1, "paid"), (3, "new")]
    incremental.incremental_overwrite(late, build, scratch, ["day"], full_refresh=True)
    assert collect(spark.read.parquet(scratch).select("order_id", "status")) == [(1, "paid"), (2, "new"), (3, "new")]


def test_upsert_keeps_unchanged_rows_and_is_repeatable(spark, scratch):
    first = orders(spark, [(1, "new", D1, T1, "a"), (2, "new", D1, T1, "b"), (3, "new", D2, T1, "c")])
    late = orders(spark, [(1, "paid", D1, T2, "d"), (4, "new", D2, T2, "e")])
    incremental.upsert(first, scratch, ["order_id"], ["day"])
    for _ in range(2):
        incremental.upsert(late, scratch, ["order_id"], ["day"])
    assert collect(spark.read.parquet(scratch).select("order_id", "status")) == [(1, "paid"), (2, "new"), (3, "new"), (4, "new")]


def test_upsert_leaves_other_partitions_untouched(spark, scratch):
    incremental.upsert(orders(spark, [(1, "new", D1, T1, "a"), (3, "new", D2, T1, "c")]), scratch, ["order_id"], ["day"])
    before = sorted(os.listdir(f"{scratch}/day=2024-01-02"))
    incremental.upsert(orders(spark, [(1, "paid", D1, T2, "d")]), scratch, ["order_id"], ["day"])
    assert sorted(os.listdir(f"{scratch}/day=2024-01-02")) == before


def test_upsert_moves_a_key_and_clears_the_emptied_partition(spark, scratch):
    incremental.upsert(orders(spark, [(1, "new", D1, T1, "a"), (2, "new", None, T1, "b")]), scratch, ["order_id"], ["day"])
    incremental.upsert(orders(spark, [(1, "moved", D2, T2, "c"), (2, "moved", D2, T2, "d")]), scratch, ["order_id"], ["day"])
    assert collect(spark.read.parquet(scratch).select("order_id", "status")) == [(1, "moved"), (2, "moved")]
    assert files.subfolders(spark, scratch) == ["day=2024-01-02"]


def test_upsert_with_two_partition_columns_and_odd_values(spark, scratch):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, a string, b int")
    incremental.upsert(rows((1, "x", "p:q/r", 1), (2, "x", "z", None), (3, "x", "z", 2)), scratch, ["k"], ["a", "b"])
    incremental.upsert(rows((1, "y", "z", 2), (2, "y", "z", 2)), scratch, ["k"], ["a", "b"])
    assert collect(spark.read.parquet(scratch).select("k", "v")) == [(1, "y"), (2, "y"), (3, "x")]
    assert files.subfolders(spark, f"{scratch}/a=z") == ["b=2"] and files.subfolders(spark, f"{scratch}/a=p%3Aq%2Fr") == []


def test_columns_follow_the_new_rows(spark, scratch):
    incremental.upsert(spark.createDataFrame([(1, "x", 5)], "k int, gone string, n int"), scratch, ["k"])
    incremental.upsert(spark.createDataFrame([(2, 7, True)], "k int, n int, added boolean"), scratch, ["k"])
    out = spark.read.parquet(scratch)
    assert out.columns == ["k", "n", "added"] and collect(out) == [(1, 5, None), (2, 7, True)]


def test_merge_new_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert collect(incremental.merge_by_key(old, new, "k")) == [(1, "a"), (2, "B"), (3, "C")]
    assert collect(incremental.merge_by_key(old, new.limit(0), "k")) == collect(old)
    assert collect(incremental.merge_by_key(old.limit(0), new, "k")) == collect(new)


def test_update_date_partitions(spark, scratch):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, at string, v string")
    update = lambda df, a, b: incremental.update_date_partitions(df, scratch, "at", "id", dt.date(2024, 1, a), dt.date(2024, 1, b))
    update(rows((1, "2024-01-01 10:00:00", "a"), (2, "2024-01-02T10:00:00", "b"), (3, "junk", "c"), (4, None, "d")), 1, 31)
    update(rows((2, "2024-01-02 11:00:00", "B"), (5, "2024-01-02 11:00:00", "e"), (6, "2024-02-09 11:00:00", "f")), 2, 3)
    assert collect(spark.read.parquet(scratch).select("id", "v")) == [(1, "a"), (2, "B"), (5, "e")]


def test_files_are_bounded(spark, scratch):
    incremental.append_partitions(spark.range(1000).withColumn("p", F.lit(1)), scratch, ["p"], rows_per_file=100)
    per_file = spark.read.parquet(scratch).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 100


def test_files_are_bounded_without_gathering(spark, scratch, monkeypatch):
    monkeypatch.setattr(incremental, "clustered", lambda *_: pytest.fail("rows were shuffled"))
    rows = spark.range(1000, numPartitions=3).withColumn("p", F.col("id") % 2)
    incremental.append_partitions(rows, scratch, ["p"], rows_per_file=100, gather=False)
    per_file = spark.read.parquet(scratch).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count"), F.sum("count")).first()[:] == (100, 1000)
    from tidemark.registry.catalog import QUERIES
    assert QUERIES["snk7_append_bounded_files"](spark, "/root/testdata/sf0.001").count() > 0


def test_runs_land_their_batches_without_a_shuffle(spark, scratch, monkeypatch):
    from tidemark.registry.landing import _land
    from tidemark.sources.bronze import Lake
    monkeypatch.setattr(incremental, "clustered", lambda *_: pytest.fail("rows were shuffled"))
    lake = Lake(spark, "/root/testdata/sf0.001")
    _land(lake, scratch, F.lit(True), "full", ("products",))
    assert extract.read_landed(spark, scratch, "products").count() == lake.bronze("products").count()


def test_insert_by_period_monthly(spark, scratch):
    dates = ["2017-12-09", "2018-01-09", "2018-02-09", "2018-03-09", "2018-04-09", "2018-05-09", "2018-06-09", "2018-07-09"]
    df = spark.createDataFrame([(i + 1, dt.datetime.fromisoformat(d)) for i, d in enumerate(dates)], "id int, created_at timestamp")
    build = lambda inside: df.where(inside)
    start, stop = dt.datetime(2018, 1, 1), dt.datetime(2018, 6, 1)
    assert incremental.insert_by_period(build, scratch, "created_at", start, stop, "month", spark) == 5
    assert collect(spark.read.parquet(scratch).select("id")) == [(n,) for n in range(2, 7)]
    incremental.insert_by_period(build, scratch, "created_at", start, stop, "month", spark)  # resumes, adds nothing
    assert spark.read.parquet(scratch).count() == 5


def test_bronze_layout_and_load_types(spark, scratch):
    df = spark.createDataFrame([(1, "2024-01-03 08:00:00", "x"), (2, "2024-01-05T08:00:00", None)], "id int, updated_at string, note_date string")
    assert landing.write_to_bronze(scratch, "orders", df, T1, "FULL", "rds") == 2
    assert landing.write_to_bronze(scratch, "orders", df.limit(0), T1, "full", "rds") == 0  # an empty batch writes nothing
    folder = landing.bronze_path(scratch, "orders", "2024-01-01", "FULL", "2024-01-05")
    assert files.exists(spark, folder)
    landing.write_to_bronze(scratch, "orders", df.where("id = 1"), T2, "incremental", "rds")
    landing.write_to_bronze(scratch, "orders", df.where("id = 1"), T2, "incremental", "rds")
    out = extract.read_landed(spark, scratch, "orders")
    assert out.count() == 3 and dict(out.dtypes)["updated_at"] == "timestamp"
    # one type in every batch: unreadable text is NULL with the text beside it
    assert dict(out.dtypes)["note_date"] == "timestamp" and out.where("note_date is null and note_date_raw = 'x'").count() == 3 - out.where("id = 2").count()
    assert out.select("_ingestion_id").distinct().count() == 3
    assert out.where("id = 1").select("_record_hash").distinct().count() == 1
    landing.write_to_bronze(scratch, "orders", df.where("id = 2"), T2, "full", "rds")  # replaces the entity
    assert collect(extract.read_landed(spark, scratch, "orders").select("id")) == [(2,)]
    landing.delete_entity(spark, scratch, "orders")
    assert not files.exists(spark, f"{scratch}/orders")


def test_shuffle_sizing():
    from tidemark.session import shuffle_partitions
    assert shuffle_partitions(1 << 30) == 200 and shuffle_partitions(10 << 40) == 81920


def test_paths():
    assert landing.bronze_path("b", "orders", "2024-01-01", "FULL") == "b/orders/ingestion_date=2024-01-01/load_type=full"
    assert landing.bronze_path("b", "orders", dt.date(2024, 1, 1), "full", dt.date(2024, 1, 2)).endswith("/event_date=2024-01-02")
    assert landing.log_path("logs", dt.datetime(2024, 1, 2, 3, 4, 5)) == "logs/2024/01/02/run-030405.log"


def test_event_date_falls_through_empty_columns(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 4))], "updated_at timestamp, order_date timestamp")
    assert landing.batch_event_date(df).first()[0] == dt.date(2024, 1, 4)
    assert landing.batch_event_date(spark.range(1)).first()[0] is None


def test_hash_ignores_column_order_but_not_nulls(spark):
    a = spark.createDataFrame([(1, None)], "x int, y string")
    assert a.select(landing.record_hash(a)).first() == a.select(landing.record_hash(a.select("y", "x"))).first()
    assert a.select(landing.record_hash(a)).first() != a.select(landing.record_hash(a.select("x"))).first()


def test_checkpoints_and_reset(spark, scratch):
    path, bronze = f"{scratch}/checkpoints", f"{scratch}/bronze"
    assert control.load_type(spark, path) == "full"
    assert control.get_last_sync(spark, path, "orders") == dt.datetime(1970, 1, 1)
    control.update_sync(spark, path, "orders", T1, 5)
    control.update_sync(spark, path, "orders", T2, 7)
    assert control.get_last_sync(spark, path, "orders") == T2
    assert control.ensure_checkpoints(spark, path).count() == 1
    assert control.load_type(spark, path) == "incremental"
    control.reset(spark, bronze, path)
    assert control.load_type(spark, path) == "full"


def test_run_log_and_window(spark, scratch):
    control.write_run_log(spark, scratch, D1, "success", {"orders": 3}, now=T1)
    control.write_run_log(spark, scratch, dt.date(2024, 1, 9), "failed", error="x", now=T2)
    last = control.last_run_date(spark.read.parquet(scratch))
    assert last.first()[0] == D1
    none = spark.createDataFrame([(None,)], "d date")
    newest = spark.createDataFrame([(dt.datetime(2024, 1, 5, 10),)], "d timestamp")
    window = lambda run, order, today: tuple(control.load_window(run, order, F.lit(today), F.lit(dt.date(2023, 1, 1))).first())
    assert window(none, none, dt.date(2024, 1, 10)) == ("initial", dt.date(2023, 1, 1), dt.date(2024, 1, 9))
    assert window(last, newest, dt.date(2024, 1, 10)) == ("ongoing", D2, dt.date(2024, 1, 9))
    assert window(none, newest, dt.date(2024, 1, 10)) == ("ongoing", dt.date(2024, 1, 6), dt.date(2024, 1, 9))
    assert window(last, newest, D2)[0] == "nothing"


def test_scratch_must_be_shared_on_a_cluster(monkeypatch):
    from tidemark import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError):
        session.scratch_root(Cluster())


def test_a_broken_write_leaves_the_old_rows(spark, scratch):
    incremental.replace_files(spark.range(3).toDF("k"), scratch)
    broken = spark.range(5).select(F.when(c("id") < 4, c("id")).otherwise(F.raise_error(F.lit("boom"))).alias("k"))
    for write in (lambda: incremental.replace_files(broken, scratch), lambda: incremental.upsert(broken, scratch, ["k"]),
                  lambda: control.ensure_checkpoints(spark, f"{scratch}-cp") and broken.write.mode("append").parquet(f"{scratch}-cp")):
        with pytest.raises(Exception, match="boom"):
            write()
    assert collect(incremental.read_target(spark, scratch)) == [(0,), (1,), (2,)]
    control.update_sync(spark, f"{scratch}-cp", "orders", T1, 5, T1)
    assert control.get_last_sync(spark, f"{scratch}-cp", "orders") == T1
    files.rename(spark, scratch, f"{scratch}__old")  # as if broken between the two renames
    assert collect(incremental.read_target(spark, scratch)) == [(0,), (1,), (2,)]


def test_staged_copies_are_deleted(spark, scratch):
    from tidemark.session import scratch_root
    before = set(files.subfolders(spark, scratch_root(spark)))
    first = orders(spark, [(1, "new", D1, T1, "a"), (2, "new", D2, T1, "b")])
    incremental.upsert(first, scratch, ["order_id"], ["day"])
    incremental.upsert(first, scratch, ["order_id"], ["day"], version="_ingestion_ts")
    landing.write_to_bronze(f"{scratch}-b", "orders", first, T1, "full", "rds")
    left = set(files.subfolders(spark, scratch_root(spark))) - before
    assert left == {x.rsplit("/", 1)[1] for x in (scratch, f"{scratch}-b")}


def test_upsert_by_version_ignores_older_rows(spark, scratch):
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, version int")
    for batch in (rows((1, "b", 2), (2, "x", 1)), rows((1, "a", 1), (2, "y", 1)), rows((1, "c", 3))):
        incremental.upsert(batch, scratch, ["k"], version="version")
    assert collect(spark.read.parquet(scratch)) == [(1, "c", 3), (2, "y", 1)]


def test_settled_keeps_the_result_only(spark, scratch):
    from tidemark.session import scratch_root, settled, stage
    before = set(files.subfolders(spark, scratch_root(spark)))

    def build():
        inner = settled(spark, lambda: stage(stage(spark.range(5)).where("id > 1")), "inner")
        return stage(inner).where("id > 2")
    out = settled(spark, build, "outer")
    assert collect(out) == [(3,), (4,)]
    left = set(files.subfolders(spark, scratch_root(spark))) - before
    assert [x.split("-")[0] for x in left] == ["outer"]
    with pytest.raises(Exception, match="boom"):
        settled(spark, lambda: stage(spark.range(3)).select(F.raise_error(F.lit("boom"))), "broken")
    assert {x.split("-")[0] for x in set(files.subfolders(spark, scratch_root(spark))) - before} <= {"outer", "broken"}
