"""Order-dependent operators against plain Python, with many slices and one hot key."""

import datetime
import decimal
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import history, joins, ordered, reshape

c = F.col


def hot_rows(n=600):
    """A third of the rows under one key, the rest over 40 keys and NULL."""
    rng = random.Random(7)
    return [(i, None if i % 50 == 0 else (0 if i % 3 == 0 else rng.randrange(1, 40)), rng.randrange(100)) for i in range(n)]


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), "id int, k int, v int").repartition(5)


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_running_sum_matches_window(hot, slices):
    order = [c("v").asc(), c("id").asc()]
    got = ordered.running_sum(hot, order, c("v"), "s", ["k"], slices)
    want = hot.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    assert collect(got.select("id", "s")) == collect(want.select("id", "s"))


def test_row_numbers_of_whole_table(hot):
    got = ordered.row_numbers(hot, [c("v").desc(), c("id").asc()], slices=13)
    want = hot.withColumn("row_number", F.row_number().over(Window.orderBy(c("v").desc(), c("id").asc())))
    assert collect(got.select("id", "row_number")) == collect(want.select("id", "row_number"))


@pytest.mark.parametrize("step,function", [(-1, F.lag), (1, F.lead)])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_neighbour_matches_window(hot, step, function, keys):
    order = [c("v").asc(), c("id").asc()]
    got = ordered.neighbour(hot, order, {"id": "near"}, step, keys, 17)
    want = hot.withColumn("near", function("id").over(Window.partitionBy(*keys).orderBy(*order)))
    assert collect(got.select("id", "near")) == collect(want.select("id", "near"))
    assert got.where("_has_neighbour <> (near is not null)").isEmpty()


def test_ntile_matches_window(hot):
    orders = {"a": [c("v").asc(), c("id").asc()], "b": [c("v").desc(), c("id").asc()]}
    small = hot.withColumns({n: F.ntile(5).over(Window.orderBy(*by)).cast("bigint") for n, by in orders.items()})
    large = ordered.ntile_columns(hot, 5, orders, slices=11)
    assert collect(small.select("id", "a", "b")) == collect(large.select("id", "a", "b"))
    sizes = [r["count"] for r in large.groupBy("a").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_ntile_of_seven(spark):
    df = spark.range(7).withColumn("t", ordered.tile_of(c("id") + 1, 7, 5))
    assert [r["t"] for r in df.orderBy("id").collect()] == [1, 1, 2, 2, 3, 4, 5]


def test_tiles_with_fewer_rows_than_tiles(spark):
    df = spark.range(3).withColumn("t", ordered.tile_of(c("id") + 1, 3, 5))
    assert [r["t"] for r in df.orderBy("id").collect()] == [1, 2, 3]


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0)], "x string, n int")
    got = reshape.repeat_rows(df, c("n"), chunk=4).groupBy("x").count()
    assert collect(got) == [("a", 25), ("b", 1)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 400), st.integers(1, 50)), min_size=1, max_size=40))
def test_history_matches_brute_force(spark, rows):
    """Several orders per second and day, some exactly at the edge of the look-back."""
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    data = [(k, i, base + dt.timedelta(days=d, seconds=(i % 3)), a) for i, (k, d, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "customer_id int, order_id int, order_date timestamp, total_amount int")
    got = {r["order_id"]: (r["previous_orders"], r["recent_spend"]) for r in history.order_history(df).collect()}
    for k, i, at, _ in data:
        before = [(t, a) for k2, i2, t, a in data if k2 == k and (t, i2) < (at, i)]
        spend = sum(a for t, a in before if t >= at - dt.timedelta(days=180))
        assert got[i] == (len(before), spend)


def test_available_products_with_ties(spark):
    import datetime as dt
    day = lambda n: dt.datetime(2024, 1, n)
    products = spark.createDataFrame([(1, day(2)), (2, day(2)), (3, day(5))], "product_id int, created_at timestamp")
    orders = spark.createDataFrame([(10, day(1)), (11, day(2)), (12, day(4)), (13, day(9))], "order_id bigint, order_date timestamp")
    assert collect(joins.available_at(orders, products)) == [(10, 3), (11, 2), (12, 2), (13, 3)]


def rows_of_every_kind(spark):
    rng = random.Random(3)
    values = [None, "", "a", "B", "é", "zz", "Z"]
    return spark.createDataFrame(
        [(i, rng.choice(values), rng.choice([None, 1.5, -2.0, float("nan"), 0.0]), rng.choice([None, datetime.datetime(2024, 1, 1, rng.randrange(20))]),
          rng.choice([None, decimal.Decimal("1.10"), decimal.Decimal("-7.00")]), rng.choice([None, datetime.date(2024, 2, 3), datetime.date(1999, 1, 1)])) for i in range(400)],
        "id int, s string, d double, t timestamp, m decimal(9,2), day date").repartition(3)


ORDERS = [lambda: [c("s").asc_nulls_last()], lambda: [c("s").desc_nulls_first(), c("d").asc()], lambda: [c("t").desc()], lambda: [F.lower("s").desc_nulls_last(), c("t").asc_nulls_last()],
          lambda: [c("m"), c("day").desc_nulls_first()], lambda: [c("d").desc(), c("m").desc_nulls_first()]]


@pytest.mark.parametrize("order", ORDERS)
def test_slices_follow_every_kind_of_order(spark, order):
    df = rows_of_every_kind(spark)
    by = [*order(), c("id").asc()]
    cut = ordered.slice_in_order(df, by, 9)
    assert cut.select(ordered.SLICE).distinct().count() > 4
    got = ordered.numbered(df, {"n": by}, 9)
    want = df.withColumn("n", F.row_number().over(Window.orderBy(*by)))
    assert collect(got.select("id", "n")) == collect(want.select("id", "n"))
    some = ordered.positions(df, by, 101, 130, "n", 9)
    assert collect(some.select("id", "n")) == collect(want.where("n between 101 and 130").select("id", "n"))


def test_building_writes_nothing(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from tidemark.registry.catalog import QUERIES

    def never(*args, **kwargs):
        raise AssertionError("written")
    monkeypatch.setattr(DataFrameWriter, "parquet", never)
    for name in ("wn4_global_ntile", "wn5_lead_and_last", "wn6_lag_over_whole_table", "wn7_row_offset", "wn9_history_at_order_time", "jn10_products_available",
                 "dq18_sequential_values", "dq19_ranges_no_gaps", "br2_segment_at_order", "br8_free_shipping", "so1_page_rows", "gld4_rfm_scores"):
        text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "/slices-" not in text and "/ntile-" not in text


def test_deep_and_early_pages_agree(hot, monkeypatch):
    from tidemark.operators import paging
    by = [c("v").desc(), c("id").asc()]
    early = [paging.page(hot, by, 50, n).select("id").collect() for n in (0, 180, 580, 700)]
    monkeypatch.setattr(paging, "EARLY", 0)
    assert early == [paging.page(hot, by, 50, n).select("id").collect() for n in (0, 180, 580, 700)]
