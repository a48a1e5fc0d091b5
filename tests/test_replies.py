"""Stored replies as batch and stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources import extract, replies
from tidemark.streaming import tables as streams

SCHEMA = "id long, at timestamp, name string, v double, chunk long"
start, end = (lambda: F.lit(dt.datetime(2024, 1, 1))), (lambda: F.lit(dt.datetime(2024, 1, 31)))


def rows(spark):
    return spark.range(3000).select("id", F.timestamp_add("MINUTE", (F.col("id") * 15).cast("int"), F.lit("2023-12-31 00:00:00").cast("timestamp")).alias("at"),
                                    F.when(F.col("id") % 7 > 0, F.concat(F.lit('n"\\é '), "id")).alias("name"), (F.col("id") / 4).alias("v"))


def collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batch_and_pruning(spark, scratch):
    df = rows(spark)
    replies.store_replies(df, scratch, "events", "at", start(), end())
    want = extract.pull_in_chunks(df, "at", start(), end()).select("id", "at", "name", "v", F.col("chunk").cast("long"))
    got = replies.read_replies(spark, scratch, SCHEMA, "events", "at")
    assert collect(got) == collect(want) and got.rdd.getNumPartitions() == 5
    some = got.where("at >= timestamp'2024-01-09 12:00:00' and at < timestamp'2024-01-14 00:00:00' and id % 2 = 0")
    assert some.rdd.getNumPartitions() == 1
    assert collect(some) == collect(want.where("at >= timestamp'2024-01-09 12:00:00' and at < timestamp'2024-01-14 00:00:00' and id % 2 = 0"))
    border = got.where("at = timestamp'2024-01-15 03:00:00'")  # a border day stands in two windows
    assert border.rdd.getNumPartitions() == 2 and border.count() == 2


def test_stream_goes_on_after_a_restart(spark, scratch):
    df, source, out = rows(spark), f"{scratch}/replies", f"{scratch}/out"

    def run():
        stream = replies.stream_replies(spark, source, SCHEMA, "events")
        streams.available_now(stream, f"{scratch}/cp", streams.append_to(out)).awaitTermination()
        return spark.read.parquet(out)
    replies.store_replies(df, source, "events", "at", start(), F.lit(dt.datetime(2024, 1, 15)))
    assert run().select("chunk").distinct().count() == 2
    replies.store_replies(df.where("at >= timestamp'2024-01-15 00:00:00'"), f"{scratch}/later", "events", "at", F.lit(dt.datetime(2024, 1, 15)), end())
    from tidemark.sinks import files
    for w in replies.windows_of(f"{scratch}/later"):  # the service has answered for two more windows
        to = f"{source}/chunk={w.chunk + 2}/start={w.start}"
        spark.read.text(w.folder).write.text(f"{to}/end={w.end}")
    assert files.names(spark, source)
    got = run()
    want = extract.pull_in_chunks(df, "at", start(), end()).select("id")
    assert collect(got.select("id")) == collect(want) and got.select("batch").distinct().count() == 2


def test_shapes_of_replies():
    one = {"id": 1}
    for reply in ('{"body": "{\\"p\\": [{\\"id\\": 1}], \\"has_more\\": false}"}', '{"p": [{"id": 1}]}', '[{"id": 1}]', '{"p": {"id": 1}}', '{"id": 1}'):
        assert replies.records_of(reply, "p") == [one]
    assert replies.records_of('{"p": []}', "p") == []
    for bad in ('{"error": "denied"}', "7", '"x"'):
        with pytest.raises(ValueError, match="unexpected reply"):
            replies.records_of(bad, "p")
