import datetime as dt
import operator

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, dedupe, filters, joins, paging, reshape

c = F.col


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_pivot_counts_absent_values_as_zero(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    out = df.groupBy("size").agg(*reshape.pivot(c("color"), ["red", "blue", "blue's"]))
    assert out.columns == ["size", "red", "blue", "blue's"]
    assert collect(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_pivot_comparison_and_affixes(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (2, 7)], "k int, v int")
    out = df.groupBy("k").agg(*reshape.pivot(c("v"), [6, 8], cmp=operator.gt, then_value=c("v"), prefix="over_", suffix="_sum"))
    assert out.columns == ["k", "over_6_sum", "over_8_sum"] and collect(out) == [(1, 9, 9), (2, 7, 0)]


def test_unpivot_and_booleans(spark):
    df = spark.createDataFrame([(1, "2017-01-01", "active", True), (2, "2017-02-01", "churned", None)],
                               "customer_id int, created_at string, status string, is_updated boolean")
    out = reshape.unpivot(df, ["customer_id"], ["CREATED_AT"], field_name="prop", value_name="val")
    assert collect(out) == [(1, "is_updated", "true"), (1, "status", "active"), (2, "is_updated", None), (2, "status", "churned")]


def test_union_relations_superset(spark):
    a = spark.createDataFrame([(1, "ada", "four")], "id int, name string, lucky string")
    b = spark.createDataFrame([(1, "teal", 7)], "id int, shade string, lucky int")
    out = reshape.union_relations({"a": a, "b": b})
    assert out.columns == ["source_relation", "id", "name", "lucky", "shade"]
    assert collect(out) == [("a", 1, "ada", "four", None), ("b", 1, None, "7", "teal")]
    assert reshape.union_relations({"a": a, "b": b}, include=["id"], source_column_name=None).columns == ["id"]
    assert reshape.union_relations({"a": a, "b": b}, exclude=["id"], where="id = 2").isEmpty()
    assert dict(reshape.union_relations({"a": a}, {"id": "string"}).dtypes)["id"] == "string"
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["nothing"])


def test_star_and_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field_1 int, field_2 int, field_3 int")
    assert df.select(reshape.star(df, ["FIELD_3"], "pre_", "_suf")).columns == ["pre_field_1_suf", "pre_field_2_suf"]
    assert reshape.filtered_columns(df, ["Field_1"]) == ["field_2", "field_3"]


def test_null_check_and_snake_case(spark):
    df = spark.createDataFrame([("", "a", 1)], "`x-y` string, z string, n int")
    assert reshape.null_check(df).first()["x-y"] is None
    assert reshape.snake_case(df).columns == ["x_y", "z", "n"]


def test_series_and_spine(spark):
    assert [r[0] for r in reshape.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        reshape.generate_series(spark, 0)
    spine = reshape.date_spine(spark.range(1), "day", F.lit("2018-01-01"), F.lit("2018-01-10")).orderBy("date_day")
    days = [r["date_day"] for r in spine.collect()]
    assert days == [dt.datetime(2018, 1, n) for n in range(1, 10)]
    assert reshape.date_spine(spark.range(1), "month", F.lit("2018-01-31"), F.lit("2018-01-31")).isEmpty()
    quarters = reshape.date_spine(spark.range(1), "quarter", F.lit("2018-01-01"), F.lit("2018-12-31"))
    assert quarters.count() == 4
    with pytest.raises(ValueError):
        reshape.date_spine(spark.range(1), "era", F.lit("2018-01-01"), F.lit("2018-01-10"))


def test_column_values(spark):
    rows = [("a", "left"), ("b", "right"), ("c", "left"), ("g", "left"), ("g", "left"), ("g", "right")]
    df = spark.createDataFrame(rows, "field string, condition string")
    top = reshape.column_values(df, "field", max_records=2, where="condition = 'left'").collect()
    assert [tuple(r) for r in top] == [("g", 2), ("a", 1)]
    df.createOrReplaceTempView("tidemark_values")
    assert sorted(reshape.table_column_values(spark, "tidemark_values", "condition")) == ["left", "right"]
    assert reshape.table_column_values(spark, "tidemark_missing", "x", default=["d"]) == ["d"]
    with pytest.raises(ValueError):
        reshape.table_column_values(spark, "tidemark_missing", "x")
    assert reshape.tables_like(spark, "default", "TIDEMARK_VAL%") == ["tidemark_values"]


def test_results_as_dict_is_whole(spark):
    assert reshape.results_as_dict(spark.range(2)) == {"id": [0, 1]}
    assert len(reshape.results_as_dict(spark.range(20_000))["id"]) == 20_000


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "play", 2)], "user_id int, event string, version int")
    out = dedupe.first_per_key(df, ["user_id", "event"], [c("version").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert collect(out) == [(1, "play", 2), (2, "play", 2)]


def test_listagg(spark):
    rows = [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 2), (2, "1", 1), (2, "p", 3), (3, "g", 1), (3, "g", 2), (3, "g", 3), (3, None, 4)]
    df = spark.createDataFrame(rows, "k int, s string, o int")
    assert collect(aggregates.listagg(df, ["k"], "s", "_|_", order_by="o")) == [(1, "a_|_b_|_c"), (2, "1_|_a_|_p"), (3, "g_|_g_|_g")]
    assert collect(aggregates.listagg(df, ["k"], "s", ",", distinct=True))[2] == (3, "g")
    assert collect(aggregates.listagg(df, ["k"], "s"))[2] == (3, "g,g,g")
    numbers = spark.createDataFrame([(1, 10), (1, 9), (1, 2), (1, 9), (1, None), (2, None)], "k int, n int")
    assert collect(aggregates.listagg(numbers, ["k"], "n", "'", distinct=True)) == [(1, "2'9'10"), (2, None)]
    assert collect(aggregates.listagg(numbers, ["k"], "n", descending=True)) == [(1, "10,9,9,2"), (2, None)]
    with pytest.raises(ValueError):
        aggregates.listagg(df, ["k"], "s", distinct=True, order_by="o")
    assert collect(aggregates.listagg_first(df, ["k"], "s", [c("o").asc()], 2, "_|_")) == [(1, "a_|_b"), (2, "1_|_a"), (3, "g_|_g")]


def test_mode_tie_goes_to_latest(spark):
    rows = [(1, "x", 1), (1, "y", 2), (2, "x", 5), (2, "x", 1), (2, "y", 9), (3, None, 1)]
    df = spark.createDataFrame(rows, "k int, v string, at int")
    assert collect(aggregates.mode_per_key(df, ["k"], "v", "at")) == [(1, "y", 1), (2, "x", 2)]


def test_watermark_and_newer_than(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, n),) for n in (1, 2, 3)], "_ingestion_ts timestamp")
    assert aggregates.watermark(df.limit(0)).first()[0] == dt.datetime(1970, 1, 1)
    newer = filters.newer_than(df, df.where("_ingestion_ts < timestamp '2024-01-03'"))
    assert collect(newer) == [(dt.datetime(2024, 1, 3),)]  # strictly newer
    assert filters.newer_than(df, None).count() == filters.newer_than(df, df.limit(0)).count() == 3


def test_set_difference(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    assert collect(joins.set_difference(a, b)) == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "y")]
    assert ("a_minus_b", 1, None, 1) in collect(joins.set_difference(a, b, counted=True))


def test_update_by_key_ignores_nulls_and_new_keys(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, s string, n int")
    new = spark.createDataFrame([(1, None, 9), (3, "z", 1)], "k int, s string, n int")
    assert collect(joins.update_by_key(old, new, "k", ["s", "n"])) == [(1, "a", 9), (2, "b", 6)]
    assert tuple(joins.changed_count(old, new, "k", "s").first()) == (1, 1)


def test_pages_cover_everything_once(spark):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i // 4) if i < 20 else None) for i in range(23)], "k int, at timestamp")
    order = [c("at").asc_nulls_last(), c("k").asc()]
    pages = [r["k"] for o in range(0, 23, 5) for r in paging.page(df, order, 5, o).collect()]
    assert sorted(pages) == list(range(23)) and len(pages) == 23
    seen, last = [], None
    while True:
        rows = paging.page_after(df, "at", "k", last, 5).collect()
        if not rows:
            break
        seen += [r["k"] for r in rows]
        last = (rows[-1]["at"], rows[-1]["k"])
    assert seen == pages
    info = paging.page_info(df, 5, 20).first()
    assert (info["total_count"], info["count"], info["has_more"], info["next_offset"]) == (23, 3, False, None)


def test_texts_of_distinct_values_join_others_in_any_number_of_partitions(spark):
    from tidemark.operators import aggregates
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n, None) for n in names}
    df = spark.createDataFrame([(1, 3), (1, 3), (1, None), (2, None), (None, 1), (1, 20)], "k long, v int")
    try:
        for n, value in names.items():
            spark.conf.set(n, value)
        df = df.join(spark.createDataFrame([(1,), (2,)], "k long"), "k")  # so the rows lie by the key already
        distinct = aggregates.listagg(df, ["k"], "v", distinct=True, name="d")
        both = aggregates.listagg(df, ["k"], "v", name="a").join(distinct, "k").join(aggregates.listagg(df, ["k"], "v", "", True, descending=True, name="last"), "k")
        found = sorted(tuple(r) for r in both.collect())
        assert sorted(map(str, distinct.collect())) == ["Row(k=1, d='3,20')", "Row(k=2, d=None)"]
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
    assert found == [(1, "3,3,20", "3,20", "203"), (2, None, None, None)]


def test_packed_hashes_sort_like_their_texts_and_are_shorter(spark):
    hexes = ["0" * 32, "f" * 32, "0" * 31 + "1", "09" + "f" * 30, "0a" + "0" * 30, "deadbeef" * 4]
    ends = ["", " ", "/", "0", "9", ":", "A", "`", "a", "f", "g", "~", "\u00e9"]
    texts = sorted({h[:n] + end for h in hexes for n in (0, 1, 2, 3, 31, 32) for end in ends}, key=str.encode)
    df = spark.createDataFrame([(x,) for x in [*texts, None]], "h string")
    rows = df.select("h", dedupe.packed_hash(c("h")).alias("p")).withColumn("u", dedupe.unpacked_hash(c("p"))).collect()
    assert all(r.u == r.h for r in rows)
    assert [r.h for r in sorted((r for r in rows if r.h is not None), key=lambda r: bytes(r.p))] == texts
    assert {len(r.p) for r in rows if r.h in hexes} == {17}


def test_latest_per_key_breaks_ties_by_any_hash_and_gives_it_back(spark):
    df = spark.createDataFrame([(1, 5, "a" * 32), (1, 5, "a" * 31 + "g"), (2, 5, "b" * 32), (2, 5, None), (3, 4, "f" * 32), (3, 5, "x"), (None, 1, "")],
                               "id int, _ingestion_ts int, _record_hash string")
    out = dedupe.latest_per_key(df, ["id"])
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} == {(1, 5, "a" * 31 + "g"), (2, 5, "b" * 32), (3, 5, "x"), (None, 1, "")}
    assert "packed" not in out.columns and "unhex(" in out._jdf.queryExecution().optimizedPlan().toString()
