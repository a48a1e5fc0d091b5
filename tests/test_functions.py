import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import arrays, numeric, text, timestamps, web

c = F.col


def values(df, column="out"):
    return [r[column] for r in df.orderBy("i").select(column).collect()]


def frame(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)


def ts(text_):
    return None if text_ is None else dt.datetime.fromisoformat(text_)


def test_parse_keeps_value_and_flags_junk(spark):
    rows = ["2024-01-02T03:04:05", "2024-01-02 03:04:05", "2024-01-02", "10:00:00", "2024", "soon", "2024-13-01T00:00:00", None]
    df = frame(spark, [(r,) for r in rows], "raw string")
    iso = df.withColumns(timestamps.parse_timestamp_safe("raw", "out"))
    both = df.withColumns(timestamps.parse_timestamp_safe("raw", "out", timestamps.parse_any))
    moment, day = dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2)
    assert values(iso) == [moment, None, day] + [None] * 5
    assert values(both) == [moment, moment, day] + [None] * 5
    assert values(both, "out_parse_error") == [False, False, False, True, True, True, True, False]


@pytest.mark.parametrize("a,b,part,expected", [
    ("2018-01-01 01:00:00", "2018-01-02 01:00:00", "day", 1),
    ("2018-01-01 01:00:00", "2018-02-01 01:00:00", "month", 1),
    ("2018-01-01 01:00:00", "2019-01-01 01:00:00", "year", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:00:00", "hour", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:01:00", "minute", 61),
    ("2018-01-01 01:00:00", "2018-01-01 02:00:01", "second", 3601),
    ("2019-12-31 00:00:00", "2019-12-27 00:00:00", "week", -1),
    ("2019-12-31 00:00:00", "2019-12-30 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-02 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-06 02:00:00", "week", 1),
    ("2018-01-31 23:59:59", "2018-04-01 00:00:00", "quarter", 1),
    (None, "2018-01-01 02:00:00", "hour", None),
    ("2018-01-01 02:00:00", None, "hour", None),
])
def test_datediff_counts_boundaries(spark, a, b, part, expected):
    df = frame(spark, [(ts(a), ts(b))], "a timestamp, b timestamp")
    assert values(df.withColumn("out", timestamps.datediff(part, c("a"), c("b")))) == [expected]


def test_datediff_unknown_part():
    with pytest.raises(ValueError):
        timestamps.datediff("fortnight", None, None)


@pytest.mark.parametrize("part,expected", [("day", "2018-01-02 01:00:00"), ("month", "2018-02-01 01:00:00"),
                                           ("year", "2019-01-01 01:00:00"), ("hour", "2018-01-01 02:00:00")])
def test_dateadd(spark, part, expected):
    df = frame(spark, [(ts("2018-01-01 01:00:00"),), (None,)], "a timestamp")
    assert values(df.withColumn("out", timestamps.dateadd(part, 1, c("a")))) == [ts(expected), None]


def test_last_day(spark):
    df = frame(spark, [(dt.date(2018, 1, 2),), (None,)], "d date")
    for part, expected in (("month", dt.date(2018, 1, 31)), ("quarter", dt.date(2018, 3, 31)), ("year", dt.date(2018, 12, 31))):
        assert values(df.withColumn("out", timestamps.last_day(part, c("d")))) == [expected, None]


def test_complete_years(spark):
    df = frame(spark, [(dt.date(1983, 8, 2),), (dt.date(1983, 8, 3),), (None,)], "d date")
    assert values(df.withColumn("out", timestamps.complete_years(c("d"), F.lit(dt.date(2001, 8, 2))))) == [18, 17, None]


def test_surrogate_key_golden(spark):
    rows = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None), ("", "", "")]
    df = frame(spark, rows, "x string, y string, z string")
    assert values(df.withColumn("out", text.surrogate_key([c("x")])))[:4] == [
        "0cc175b9c0f1b6a831c399e269772661", "0cc175b9c0f1b6a831c399e269772661",
        "d41d8cd98f00b204e9800998ecf8427e", "d41d8cd98f00b204e9800998ecf8427e"]
    keys = values(df.withColumn("out", text.surrogate_key([c("x"), c("y"), c("z")])))
    assert keys == ["7b193b3d33184464106f41ddf733783b", "c5fd1b92380c6222ab0ef67839208624", "267743defab4558f1940311b66274e26",
                    "cfab1ba8c67c7c838db98d666f02a132", "cfab1ba8c67c7c838db98d666f02a132"]


def test_text_helpers(spark):
    df = frame(spark, [("lighthouse", 5), ("harbour", 2), ("tide", 9), ("tide", 0)], "s string, n int")
    assert values(df.withColumn("out", text.right(c("s"), c("n")))) == ["house", "ur", "tide", ""]
    df = frame(spark, [("lighthouse", "house"), ("tide", "sand"), ("harbour", "our")], "s string, p string")
    assert values(df.withColumn("out", F.position(c("p"), c("s")))) == [6, 0, 5]
    df = frame(spark, [("abc",), ("123",), (None,)], "s string")
    assert values(df.withColumn("out", text.safe_cast(c("s"), "int"))) == [None, 123, None]
    assert text.slugify("Mixed Case-Name: 50%!") == "mixed_case_name_50"
    df = frame(spark, [("Mixed Case-Name: 50%!",)], "s string")
    assert values(df.withColumn("out", text.slugify_column(c("s")))) == ["mixed_case_name_50"]
    assert text.quote_name("a`b-c") == "`a``b-c`"


def test_numbers(spark):
    df = frame(spark, [(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert values(df.withColumn("out", numeric.safe_add([c("a"), c("b"), c("c")]))) == [6, 4, 2, 0]
    amounts = [199999.0, 200000.0, 310000.0, 399999.99, 400000.0, 499999.0, 599999.0, 600000.0]
    df = frame(spark, [(a,) for a in amounts], "a double")
    bucket = numeric.width_bucket(c("a"), F.lit(200000.0), F.lit(600000.0), F.lit(4))
    assert values(df.withColumn("out", bucket)) == [0, 1, 2, 2, 3, 3, 4, 5]
    df = frame(spark, [(0.0, 0.0, 0.0, 90.0)], "a double, b double, c double, d double")
    at = [c(n) for n in "abcd"]
    assert values(df.withColumn("out", F.round(numeric.haversine(*at)))) == [6222]
    assert values(df.withColumn("out", F.round(numeric.haversine(*at, unit="km")))) == [10013]
    with pytest.raises(ValueError):
        numeric.haversine(*at, unit="ft")
    df = frame(spark, [(1.0, 2.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert values(df.withColumn("out", numeric.ratio(c("a"), c("b")))) == [0.5, 0.0, 0.0]


def test_urls(spark):
    hosts = {"shop.example.co.uk?utm_source=mail&page=3": "shop.example.co.uk", "http://example.com/2020/05/tips/": "example.com",
             "https://www.example.org/a/b": "www.example.org", "android-app://m.example.net/": "m.example.net",
             "docs.example.com/a/index.js?utm_source=mail": "docs.example.com"}
    df = frame(spark, [(u,) for u in hosts], "u string")
    assert values(df.withColumn("out", web.url_host(c("u")))) == list(hosts.values())
    paths = {"shop.example.co.uk?utm_source=mail": "", "http://example.com/2020/05/tips/": "2020/05/tips/",
             "https://example.com/2020/05/tips/?utm_source=mail": "2020/05/tips/", "plainhost": "plainhost"}
    df = frame(spark, [(u,) for u in paths], "u string")
    assert values(df.withColumn("out", web.url_path(c("u")))) == list(paths.values())
    df = frame(spark, [("http://a.com/m?utm_medium=mail",), ("http://a.com/m?utm_medium=mail&utm_source=may",)], "u string")
    assert values(df.withColumn("out", web.url_parameter(c("u"), "utm_medium"))) == ["mail", "mail"]
    assert values(df.withColumn("out", web.url_parameter(c("u"), "utm_source"))) == [None, "may"]


def test_arrays(spark):
    df = frame(spark, [(1, 2)], "a int, b int")
    pair = arrays.array_construct([c("a"), c("b")])
    out = df.select("i", arrays.array_to_text(pair).alias("x"), arrays.array_to_text(arrays.array_append(pair, F.lit(3))).alias("y"),
                    arrays.array_to_text(arrays.array_concat(pair, arrays.array_construct([F.lit(4)]))).alias("z"),
                    arrays.array_to_text(arrays.array_construct([])).alias("e")).first()
    assert (out["x"], out["y"], out["z"], out["e"]) == ("[1,2]", "[1,2,3]", "[1,2,4]", "[]")


def test_jdbc_options_push_columns_and_increment_down():
    import datetime as dt

    from tidemark.sources.extract import EXTRACTS, jdbc_options
    ny = dt.timezone(dt.timedelta(hours=-5))
    options = jdbc_options("orders", "jdbc:x", dt.datetime(2024, 1, 1, 7, tzinfo=ny), (1, 900), 8, "shop")
    assert options["dbtable"].startswith("(SELECT order_id, ") and options["dbtable"].endswith(
        "FROM shop.orders WHERE updated_at >= TIMESTAMP '2024-01-01 12:00:00.000000') AS increment")
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("order_id", "1", "900", "8")
    whole = jdbc_options("products", "jdbc:x")
    assert "WHERE" not in whole["dbtable"] and "numPartitions" not in whole and all(c in whole["dbtable"] for c in EXTRACTS["products"][1])
    with pytest.raises(ValueError):
        jdbc_options("payments", "jdbc:x")
