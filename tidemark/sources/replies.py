"""Windowed API pulls as a Spark data source.

Replies are stored the way a service gives them, as envelopes in JSON, one folder a window (``chunk=N/start=DAY/end=DAY``). The source has one input partition
for each window, so windows are pulled side by side and a lost one is pulled again alone. Filters on the time column narrow the windows: a window that
cannot hold a wanted instant is not opened. As a stream its offset is the next window, so a restarted query goes on where it stopped.

    spark.dataSource.register(StoredReplies)
    spark.read.format("stored_replies").schema("event_id bigint, ts timestamp, chunk bigint").option("entity", "events").option("ts", "ts").load(path)

The column ``chunk``, if asked for, is the number of the window. Both border days belong to a window, as in the service, so a row of a border day comes twice.
Times without a zone are UTC.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan,
                                    LessThanOrEqual)

from tidemark.sources.extract import CHUNK_DAYS, pull_in_chunks

PAGE = 1000  # fixed value: records of one reply
_SALTS = 64


def store_replies(df: DataFrame, path: str, entity: str, ts: str, start: Column, end: Column, days: int = CHUNK_DAYS) -> None:
    """What a service would answer for every window of the range: pages of ``PAGE`` records at most."""
    from pyspark.sql import Window
    first = F.date_add(F.to_date(start), (F.col("chunk") * days).cast("int"))
    pulled = pull_in_chunks(df, ts, start, end, days).withColumns({"_start": first, "_end": F.least(F.date_add(first, days), F.to_date(end))})
    record = F.struct(*[F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(f.name) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
                        for f in df.schema.fields])
    rows = pulled.select("chunk", "_start", "_end", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)).alias("salt"), record.alias("record"))
    nth = F.row_number().over(Window.partitionBy("chunk", "salt").orderBy(F.xxhash64("record")))
    pages = rows.withColumn("page", F.floor((nth - 1) / PAGE)).groupBy("chunk", "_start", "_end", "salt", "page").agg(F.collect_list("record").alias(entity))
    reply = F.to_json(F.struct(F.to_json(F.struct(F.col(entity), F.lit(False).alias("has_more"))).alias("body")))
    (pages.select(F.col("chunk"), F.col("_start").alias("start"), F.col("_end").alias("end"), reply.alias("value"))
     .write.partitionBy("chunk", "start", "end").text(path))


@dataclass
class ReplyWindow(InputPartition):
    chunk: int
    start: date
    end: date
    folder: str


def _moment(value) -> datetime | None:
    if isinstance(value, datetime):
        return value.astimezone(timezone.utc)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day, tzinfo=timezone.utc)
    return None


def windows_of(path: str) -> list[ReplyWindow]:
    """All stored windows, in order."""
    fs, base = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    found = {}
    for info in fs.get_file_info(pafs.FileSelector(base, recursive=True)):
        parts = dict(p.split("=", 1) for p in info.path.removeprefix(base).strip("/").split("/") if "=" in p)
        if info.type == pafs.FileType.Directory and {"chunk", "start", "end"} <= set(parts):
            found[int(parts["chunk"])] = ReplyWindow(int(parts["chunk"]), date.fromisoformat(parts["start"]), date.fromisoformat(parts["end"]), info.path)
    return [found[k] for k in sorted(found)]


def records_of(reply: str, entity: str) -> list[dict]:
    """The records of one reply: a list under the entity's name, one object, or a bare list, with or without a ``body`` around it."""
    told = json.loads(reply)
    if isinstance(told, dict) and isinstance(told.get("body"), str):
        told = json.loads(told["body"])
    listed = told.get(entity) if isinstance(told, dict) else told
    if listed is None and isinstance(told, dict) and "error" not in told:
        listed = told
    if isinstance(listed, dict):
        listed = [listed]
    if not isinstance(listed, list):
        raise ValueError(f"unexpected reply: {reply[:200]}")
    return listed


def _reader_of(kind: T.DataType):
    if isinstance(kind, T.TimestampType):
        def moment(v):
            at = datetime.fromisoformat(v)
            return at if at.tzinfo else at.replace(tzinfo=timezone.utc)
        return moment
    if isinstance(kind, T.TimestampNTZType):
        return datetime.fromisoformat
    if isinstance(kind, T.DateType):
        return date.fromisoformat
    if isinstance(kind, T.DecimalType):
        return lambda v: Decimal(str(v))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float
    return lambda v: v


def _read(window: ReplyWindow, path: str, schema: T.StructType, entity: str) -> Iterator[tuple]:
    fs = pafs.FileSystem.from_uri(path)[0] if "://" in path or path.startswith("file:") else pafs.LocalFileSystem()
    readers = [(f.name, _reader_of(f.dataType)) for f in schema.fields]
    for info in fs.get_file_info(pafs.FileSelector(window.folder)):
        if info.type != pafs.FileType.File or info.base_name.startswith(("_", ".")):
            continue
        with fs.open_input_stream(info.path) as stream:
            rest = b""
            while chunk := stream.read(1 << 20):
                *lines, rest = (rest + chunk).split(b"\n")
                for line in lines:
                    yield from _rows(line, window, readers, entity)
            yield from _rows(rest, window, readers, entity)


def _rows(line: bytes, window: ReplyWindow, readers: list, entity: str) -> Iterator[tuple]:
    if not line.strip():
        return
    for record in records_of(line.decode(), entity):
        yield tuple(window.chunk if name == "chunk" else None if record.get(name) is None else reader(record[name]) for name, reader in readers)


class ReplyReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.entity, self.ts = schema, options["path"], options["entity"], options.get("ts")
        self.low = datetime.min.replace(tzinfo=timezone.utc)
        self.high = datetime.max.replace(tzinfo=timezone.utc)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Notes the range of the time column. Every filter is still applied by Spark, as a window holds whole days."""
        for f in filters:
            at = _moment(getattr(f, "value", None)) if getattr(f, "attribute", None) == (self.ts,) else None
            if at is not None and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                self.low = max(self.low, at)
            if at is not None and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                self.high = min(self.high, at)
            yield f

    def partitions(self) -> list[ReplyWindow]:
        """Windows whose days, the border days included, can hold an instant of the range."""
        return [w for w in windows_of(self.path) if _moment(w.end) + timedelta(days=1) > self.low and _moment(w.start) <= self.high]

    def read(self, partition: ReplyWindow) -> Iterator[tuple]:
        return _read(partition, self.path, self.schema, self.entity) if partition is not None else iter(())


class ReplyStream(DataSourceStreamReader):
    """Offsets count windows; a window is delivered once it is stored."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.entity = schema, options["path"], options["entity"]

    def initialOffset(self) -> dict:
        return {"chunk": 0}

    def latestOffset(self) -> dict:
        return {"chunk": max((w.chunk + 1 for w in windows_of(self.path)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[ReplyWindow]:
        return [w for w in windows_of(self.path) if start["chunk"] <= w.chunk < end["chunk"]]

    def read(self, partition: ReplyWindow) -> Iterator[tuple]:
        return _read(partition, self.path, self.schema, self.entity)


class StoredReplies(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stored_replies"

    def reader(self, schema: T.StructType) -> ReplyReader:
        return ReplyReader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> ReplyStream:
        return ReplyStream(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StoredReplies)


def read_replies(spark: SparkSession, path: str, schema: str, entity: str, ts: str) -> DataFrame:
    register(spark)
    return spark.read.format("stored_replies").schema(schema).option("entity", entity).option("ts", ts).load(path)


def stream_replies(spark: SparkSession, path: str, schema: str, entity: str) -> DataFrame:
    register(spark)
    return spark.readStream.format("stored_replies").schema(schema).option("entity", entity).load(path)
