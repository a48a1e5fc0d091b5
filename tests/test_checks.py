"""Every check on rows that pass and on rows that fail."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks

c = F.col


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "Madrid", None), (2, "Berlin", 3), (2, "Madrid", 4), (None, "Paris", 5)],
                                 "id int, city string, n int")


def test_column_checks(people):
    assert checks.not_null(people, "id").count() == 1
    assert checks.not_null(people, "id", where="city <> 'Paris'").isEmpty()
    assert collect(checks.unique(people, "id")) == [(2, 2)]
    assert checks.unique(people, "id", where="city = 'Madrid'").isEmpty()
    assert collect(checks.accepted_values(people, "city", ["Madrid", "Paris"])) == [("Berlin", 1)]
    assert checks.accepted_values(people, "n", [3, 4, 5]).isEmpty()  # NULL passes
    assert collect(checks.not_accepted_values(people, "city", ["Madrid", "Rome"])) == [("Madrid",)]
    assert checks.not_empty_string(people.withColumn("e", F.lit("")), "e").count() == 4
    assert checks.assert_equal(people, "id", "n").count() == 2


def test_relationships(spark, people):
    parents = spark.createDataFrame([(1,), (1,), (None,)], "pid int")
    assert collect(checks.relationships(people, "id", parents, "pid")) == [(2,), (2,)]
    assert checks.orphan_count(people, "id", parents, "pid").first()[0] == 2
    assert checks.orphan_count(people.where("id = 1"), "id", parents, "pid").first()[0] == 0
    assert checks.relationships_where(people, "id", parents, "pid", from_condition="id <> 2").isEmpty()
    assert checks.relationships_where(people, "id", parents, "pid", to_condition="pid > 1").count() == 3


def test_expressions_and_ranges(people):
    assert checks.expression_is_true(people, "> 3", "n").count() == 1
    assert checks.expression_is_true(people, "n > id").isEmpty()  # unknown passes
    assert checks.expression_is_true(people, "n > 3", condition="id = 2").count() == 1
    assert checks.accepted_range(people, "n", 3, 5).isEmpty()
    assert checks.accepted_range(people, "n", 3, 5, inclusive=False).count() == 2
    assert checks.accepted_range(people, "n", min_value=4).count() == 1
    assert checks.accepted_range(people, "n", max_value=4, where="id = 2").isEmpty()
    with pytest.raises(ValueError):
        checks.accepted_range(people, "n")


def test_aggregate_checks(spark, people):
    blank = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert checks.at_least_one(people, "n").isEmpty() and checks.at_least_one(blank, "a").count() == 1
    assert checks.not_constant(people, "n").isEmpty() and checks.not_constant(blank, "b").count() == 1
    assert checks.not_constant(blank, "a").isEmpty()
    assert checks.not_null_proportion(people, "n", 0.75, 0.75).isEmpty()
    assert collect(checks.not_null_proportion(people, "n", 0.8)) == [(0.75,)]
    assert collect(checks.unique_combination(people, ["city"])) == [("Madrid",)]
    nulls = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert checks.unique_combination(nulls, ["a", "b"]).count() == 1


def test_table_comparisons(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "y int")
    assert checks.cardinality_equality(a, "x", a, "x").isEmpty()
    assert collect(checks.cardinality_equality(a, "x", b, "y")) == [(2, 1), (2, 2), (3, 1)]
    assert checks.equality(a, b, None, counted=False).count() == 1  # set-based: the copy of 2 is invisible
    assert collect(checks.equality(a, b, counted=True)) == [("a_minus_b", 2, 1), ("b_minus_a", 3, 1)]
    assert checks.equality_failures(checks.equality(a, b)).first()[0] == 2
    assert tuple(checks.equal_rowcount(a, b).first()) == (3, 3, 0)
    assert checks.fewer_rows_than(a, b).first()["row_count_delta"] == 1
    assert checks.fewer_rows_than(a.limit(1), b).first()["row_count_delta"] == 0
    assert checks.fewer_rows_than(a, b.limit(1)).first()["row_count_delta"] == 2


def test_recency(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 9),)], "at timestamp")
    now = F.lit(dt.datetime(2024, 1, 10))
    assert checks.recency(df, "at", "day", 1, now).isEmpty()
    assert checks.recency(df, "at", "hour", 12, now).count() == 1


@pytest.mark.parametrize("slices", [None, 9])
def test_sequences(spark, slices):
    even = spark.createDataFrame([(n,) for n in (2, 4, 6, 8, 10)], "v int")
    assert checks.sequential_values(even, "v", 2, slices=slices).isEmpty()
    assert checks.sequential_values(even, "v", 1, slices=slices).count() == 4
    copies = spark.createDataFrame([(1,)] * 30 + [(2,)] * 5 + [(4,), (None,)], "v int")
    got = collect(checks.sequential_values(copies, "v", slices=slices))
    assert got == sorted([(1, 1)] * 29 + [(2, 2)] * 4 + [(4, 2)], key=repr)
    hours = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in (1, 2, 3, 5)], "at timestamp")
    assert collect(checks.sequential_values(hours, "at", 1, "hour", slices)) == [(dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 3))]


def test_ranges(spark):
    def bad(rows, **options):
        df = spark.createDataFrame(rows, "lo int, hi int")
        return checks.mutually_exclusive_ranges(df, "lo", "hi", **options).count()
    touching, gap = [(0, 1), (1, 2), (2, 4)], [(0, 1), (2, 3)]
    assert bad(touching, gaps="not_allowed") == 0 and bad(touching) == 0 and bad(touching, gaps="required") == 2
    assert bad(gap, gaps="required") == 0 and bad(gap, gaps="not_allowed") == 1 and bad(gap, slices=5) == 0
    assert bad([(0, 3), (2, 4)]) == 1
    assert bad([(0, 0), (1, 2)]) == 1 and bad([(0, 0), (0, 2)], zero_length_range_allowed=True) == 0
    assert bad([(0, None), (1, 2)]) == 1 and bad([(None, 5)]) == 1
    assert bad([(5, 6)] * 20) == 19  # copies overlap, the last one is free
    with pytest.raises(ValueError):
        bad(gap, gaps="some")


def test_ranges_per_key(spark):
    rows = [(1, dt.date(2019, 1, 1), dt.date(2019, 2, 1)), (1, dt.date(2019, 3, 3), dt.date(2019, 4, 1)),
            (2, dt.date(2019, 1, 6), dt.date(2019, 7, 2)), (2, dt.date(2019, 7, 3), dt.date(2019, 8, 1))]
    df = spark.createDataFrame(rows, "subscription_id int, valid_from date, valid_to date")
    check = lambda gaps: checks.mutually_exclusive_ranges(df, "valid_from", "valid_to", "subscription_id", gaps, slices=4).count()
    assert check("allowed") == 0 and check("required") == 0 and check("not_allowed") == 2


def test_summary_severity(spark, people):
    suite = [checks.Check("p", "not_null_id", broken=c("id").isNull()),
             checks.Check("p", "not_null_city", broken=c("city").isNull()),
             checks.Check("p", "positive_n", broken=checks.violates("> 3", "n"), severity="warn"),
             checks.Check("p", "unique_id", failing=lambda t: checks.unique(t["p"], "id"))]
    got = {r["test"]: (r["failures"], r["status"]) for r in checks.run_checks({"p": people}, suite).collect()}
    assert got == {"not_null_id": (1, "fail"), "not_null_city": (0, "pass"), "positive_n": (1, "warn"), "unique_id": (1, "fail")}


def test_declared_suite_size():
    suite = checks.declared_suite()
    assert len(suite) == 33 and len({(x.model, x.name) for x in suite}) == 33
