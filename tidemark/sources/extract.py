"""Readers of the landing step: table extracts, dated folders, windowed API pulls, envelopes and seeds."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quote_name
from tidemark.functions.timestamps import aware, parse_any
from tidemark.operators.filters import INITIAL
from tidemark.sinks import files

# The columns of each extract and the column its increment is read by.
EXTRACTS: dict[str, tuple[str, list[str]]] = {
    "customers": ("updated_at", ["customer_id", "first_name", "last_name", "email", "phone", "country", "city", "state",
                                 "postal_code", "address", "signup_date", "created_at", "updated_at",
                                 "customer_segment", "date_of_birth", "gender"]),
    "products": ("created_at", ["product_id", "product_name", "category", "sub_category", "brand", "price", "cost",
                                "created_at", "color"]),
    "orders": ("updated_at", ["order_id", "customer_id", "order_date", "payment_date", "shipment_date",
                              "delivered_date", "created_at", "updated_at", "order_status", "payment_status",
                              "subtotal", "discount_amount", "tax_amount", "shipping_cost", "total_amount",
                              "payment_method", "payment_id", "shipping_carrier", "tracking_number",
                              "customer_segment_at_order"]),
}
FETCH_ROWS = 10_000  # fixed value: rows the database hands over at a time
API_START = "2024-01-01"  # fixed value: first day of a full API pull
CHUNK_DAYS = 7


def extract(source: DataFrame, entity: str, since: Column | None = None, ordered: bool = False) -> DataFrame:
    """The entity's columns of rows changed at or after ``since``; delivery order only on request."""
    if entity not in EXTRACTS:
        raise ValueError(f"unknown entity {entity!r}; known are {sorted(EXTRACTS)}")
    ts, columns = EXTRACTS[entity]
    mark = F.lit(INITIAL).cast("timestamp") if since is None else since
    rows = source.select(*columns).where(F.col(ts) >= mark)
    return rows.orderBy(ts) if ordered else rows


def jdbc_options(entity: str, url: str, since: datetime | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1,
                 schema: str | None = None) -> dict[str, str]:
    """Reader options that let the database select an entity's columns and its increment.

    ``bounds`` are the lowest and highest key: with them the database is read in ``partitions`` parallel key ranges.
    """
    if entity not in EXTRACTS:
        raise ValueError(f"unknown entity {entity!r}; known are {sorted(EXTRACTS)}")
    ts, columns = EXTRACTS[entity]
    table = f"{schema}.{entity}" if schema else entity
    where = f" WHERE {ts} >= TIMESTAMP '{aware(since).astimezone(timezone.utc):%Y-%m-%d %H:%M:%S.%f}'" if since else ""
    options = {"url": url, "dbtable": f"(SELECT {', '.join(columns)} FROM {table}{where}) AS increment", "fetchsize": str(FETCH_ROWS)}
    if bounds and partitions > 1:
        options |= {"partitionColumn": columns[0], "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, entity: str, url: str, since: datetime | None = None, bounds: tuple[int, int] | None = None,
              partitions: int = 1, **options: str) -> DataFrame:
    """Rows of an entity changed at or after ``since``, straight from the database."""
    return spark.read.format("jdbc").options(**jdbc_options(entity, url, since, bounds, partitions), **options).load()


def read_date_partitions(spark: SparkSession, path: str, start: date | str, end: date | str) -> DataFrame | None:
    """Rows of the ``date=`` folders in a closed range (only those folders are listed as input); None
    when nothing was ever written."""
    if not files.exists(spark, path):
        return None
    day = F.col("date")
    return spark.read.parquet(path).where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_by_date_range(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows dated inside a closed range, for text and timestamp columns alike; missing dates drop out."""
    c = F.col(f"`{column}`")
    day = F.to_date(parse_any(c) if isinstance(df.schema[column].dataType, T.StringType) else c)
    return df.where(day.between(start, end))


def pull_start(last_sync: str | None) -> Column:
    """Start of an API pull: the last sync when it can be read, else the first day of a full pull."""
    full = F.lit(API_START).cast("timestamp")
    if last_sync is None or last_sync == INITIAL:
        return full
    text = F.lit(last_sync)
    return F.coalesce(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text)), full)


def chunk_bounds(spark: SparkSession, start: Column, end: Column, days: int = CHUNK_DAYS) -> DataFrame:
    """The chunks of a pull: ``chunk``, ``chunk_start``, ``chunk_end``; the last one ends at ``end``."""
    starts = F.sequence(start, end, F.expr(f"INTERVAL {days} DAYS"))
    at = F.col("chunk_start")
    return (spark.range(1).select(F.posexplode(starts).alias("chunk", "chunk_start")).where(at < end)
            .withColumn("chunk_end", F.least(F.timestamp_add("DAY", F.lit(days), at), end)))


def pull_in_chunks(df: DataFrame, ts: str, start: Column, end: Column, days: int = CHUNK_DAYS) -> DataFrame:
    """Every row with the chunk(s) that deliver it.

    A chunk covers whole days from the day it starts to the day it ends, both included, so a row of a border
    day is delivered twice (and deduplicated later). The chunk follows from the day by arithmetic; no
    row is compared with a list of chunks.
    """
    first, last = F.to_date(start), F.to_date(end)
    day = F.to_date(ts)
    offset = F.datediff(day, first)
    span = F.unix_seconds(end) - F.unix_seconds(start)
    chunks = F.ceil(span / (days * 86400)).cast("int")  # number of chunks
    own = F.least(F.floor(offset / days).cast("int"), chunks - 1)
    on_border = (offset % days == 0) & (offset > 0) & (F.floor(offset / days).cast("int") <= chunks - 1)
    delivered = F.when(on_border, F.array(own - 1, own)).otherwise(F.array(own))
    return df.where(day.between(first, last) & (start < end)).withColumn("chunk", F.explode(delivered))


_REWRITTEN = r"^(-?[0-9][0-9.eE+-]*|[+-]?(NaN|INF|Infinity)|[{\[][\s\S]*)$"
_PLAIN = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType())


def _same_either_way(value: Column, kind: T.DataType) -> Column:
    """Is there, and is the same if its JSON text was written anew before: texts of numbers, objects and lists may not be."""
    if not isinstance(kind, T.StringType):
        return value.isNotNull()
    return F.coalesce(~value.rlike(_REWRITTEN), F.lit(False))


def unwrap_envelope(df: DataFrame, column: str, entity: str, record: str) -> DataFrame:
    """Records of API replies held as JSON text, one row each.

    A reply may wrap its payload in a ``body`` string; the payload is an object with a list under the
    entity's name, one object, or a bare list. ``record`` is the DDL of one record. A reply of any other shape
    raises an error. The other columns of ``df`` are kept.
    """
    raw = F.trim(F.col(column))
    body = F.coalesce(F.get_json_object(raw, "$.body"), raw)
    text = F.trim(body)
    listed = F.get_json_object(text, f"$.{entity}")
    options = {"mode": "PERMISSIVE"}
    many, one = f"array<struct<{record}>>", f"struct<{record}>"

    def records(c: Column) -> Column:
        return F.from_json(c, many, options)

    payload = (F.when(text.startswith("["), records(text))
               .when(listed.startswith("["), records(listed))
               .when(listed.startswith("{"), F.array(F.from_json(listed, one, options)))
               .when(text.startswith("{") & F.get_json_object(text, "$.error").isNull() & listed.isNull(),
                     F.array(F.from_json(text, one, options)))
               .otherwise(F.raise_error(F.concat(F.lit("unexpected reply: "), F.substring(text, 1, 200)))))
    rows, kept = df, [F.col(quote_name(c)) for c in df.columns if c != column]
    fields = T.StructType.fromDDL(record).fields
    if entity.isidentifier() and entity != "body" and all(f.dataType in _PLAIN for f in fields):
        # the usual reply is parsed once; it takes the long way if any value is missing or may read differently there
        told = f"struct<body string, {quote_name(entity)}: {many}>"
        rows = df.withColumn("_told", F.when(raw.startswith("{"), F.from_json(raw, told, options)))
        listed_once = F.col("_told")[entity]
        usual = F.col("_told.body").isNull() & F.forall(listed_once, lambda r: reduce(and_, [_same_either_way(r[f.name], f.dataType) for f in fields]))
        payload = F.when(usual, listed_once).otherwise(payload)
    return rows.withColumn("_record", F.explode(payload)).select(*kept, "_record.*")


def read_api(fetch: Callable[[Column, Column], DataFrame], entity: str, record: str, since: Column, until: Column) -> DataFrame:
    """Records of an API changed from ``since`` to ``until``.

    ``fetch(start, end)`` gives the replies of a window as JSON text in ``reply``, chunk by chunk; how they are fetched is its
    business. A row of a border day comes twice and is deduplicated later, like any repeated delivery.
    """
    return unwrap_envelope(fetch(since, until).select("reply"), "reply", entity, record)


def read_landed(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All landed folders of an entity as one table; marker, manifest and temporary files are left out."""
    from tidemark.sinks.landing import MISFITS, declared
    base = f"{root}/{entity}"
    reader = spark.read.option("basePath", base).option("pathGlobFilter", "*.parquet")
    schema = declared(spark, root, entity)
    # without a declared schema (files of another writer) the footers tell
    reader = reader.schema(schema.add(MISFITS, "string")) if schema else reader.option("mergeSchema", True)
    return reader.parquet(f"{base}/ingestion_date=*")


def register_landed(spark: SparkSession, root: str, entity: str, name: str, seen: set[str] | frozenset[str] = frozenset()) -> list[str]:
    """Registers the landed table under ``name`` and returns the ingestion folders not seen before."""
    folders = [f for f in files.subfolders(spark, f"{root}/{entity}") if f.startswith("ingestion_date=")]
    fresh = [f for f in folders if f not in seen]
    if fresh:
        read_landed(spark, root, entity).createOrReplaceTempView(name)
    return fresh


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed CSV file with a header."""
    return spark.read.schema(schema).csv(path, header=True)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def next_id(df: DataFrame, key: str) -> DataFrame:
    """One row: the first free id."""
    return df.agg((F.coalesce(F.max(key), F.lit(0)) + 1).alias("next_id"))
