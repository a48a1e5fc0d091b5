"""Landing raw rows as partitioned Parquet with audit columns."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quote_name
from tidemark.functions.timestamps import aware, parse_any
from tidemark.session import staged
from tidemark.sinks import files

# Where a batch's event date is looked up, in this order; names read as timestamps.
EVENT_DATES = ["updated_at", "created_at", "order_date", "signup_date", "payment_date", "shipment_date"]
TIMESTAMP_SUFFIXES = ("_at", "_date")
INGESTED = "_ingestion_ts"
RAW, MISFITS, SCHEMAS = "_raw", "_misfits", "_schemas"


def record_hash(df: DataFrame) -> Column:
    """md5 of the record as JSON with its columns in name order, NULLs spelled out."""
    fields = F.struct(*[F.col(quote_name(c)) for c in sorted(df.columns)])
    return F.md5(F.to_json(fields, {"ignoreNullFields": "false"}))


def add_bronze_metadata(df: DataFrame, ingested_at: datetime, system: str) -> DataFrame:
    """Audit columns: ingestion time, source system, change-detection hash and a unique id."""
    return df.withColumns({INGESTED: F.lit(aware(ingested_at)), "_source_system": F.lit(system),
                           "_record_hash": record_hash(df), "_ingestion_id": F.uuid()})


def coerce_timestamps(df: DataFrame) -> DataFrame:
    """Text columns named like timestamps become timestamps; a column with any unreadable value stays text.

    All candidate columns are judged in one aggregation.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
             and (f.name.endswith(TIMESTAMP_SUFFIXES) or f.name == INGESTED)]
    if not names:
        return df
    bad = df.agg(*[F.count_if(F.col(quote_name(n)).isNotNull() & parse_any(n).isNull()).alias(n) for n in names]).first()
    return df.withColumns({n: parse_any(n) for n in names if bad[n] == 0})


def with_parsed_timestamps(df: DataFrame) -> DataFrame:
    """Text columns named like timestamps become timestamps, NULL where a value cannot be read, with the text as delivered beside them.

    So a column has the same type in every batch, whatever single values look like, and no text is lost.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name.endswith(TIMESTAMP_SUFFIXES)]
    return df.withColumns({**{n: parse_any(n) for n in names}, **{f"{n}{RAW}": F.col(quote_name(n)) for n in names}})


def _schemas(root: str, entity: str) -> str:
    return f"{root}/{SCHEMAS}/{entity}"


def declared(spark: SparkSession, root: str, entity: str) -> T.StructType | None:
    """The columns of an entity: those of its first batch, then what later ones added."""
    path = _schemas(root, entity)
    if not files.exists(spark, path):
        return None
    rows = spark.read.schema("at timestamp, columns string").parquet(path).orderBy("at").collect()  # one row per change
    fields: dict[str, T.StructField] = {}
    for row in rows:
        for f in T.StructType.fromJson(json.loads(row["columns"])).fields:
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values())) if fields else None


def declare(spark: SparkSession, root: str, entity: str, schema: T.StructType, afresh: bool = False) -> T.StructType:
    """Adds the columns of a batch that are new to the entity's declared ones; only ever appends, unless begun ``afresh``."""
    if afresh:
        files.delete(spark, _schemas(root, entity))
    known = declared(spark, root, entity)
    added = [T.StructField(f.name, f.dataType) for f in schema.fields if known is None or f.name not in known.names]
    if added:
        row = (datetime.now(timezone.utc), T.StructType(added).json())
        spark.createDataFrame([row], "at timestamp, columns string").coalesce(1).write.mode("append").parquet(_schemas(root, entity))
    return T.StructType([*(known.fields if known else []), *added])


def in_declared_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in all declared columns; a value that does not fit its type becomes NULL and is kept as text in ``_misfits``."""
    wrong = [f for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    misfits = [F.when(F.col(quote_name(f.name)).isNotNull() & F.col(quote_name(f.name)).try_cast(f.dataType).isNull(), F.col(quote_name(f.name)).cast("string"))
               .alias(f.name) for f in wrong]
    kept = F.to_json(F.struct(*misfits)) if misfits else F.lit(None).cast("string")
    fitted = [F.col(quote_name(f.name)) if f.name in df.columns and f not in wrong
              else F.col(quote_name(f.name)).try_cast(f.dataType).alias(f.name) if f in wrong
              else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*fitted, F.nullif(kept, F.lit("{}")).alias(MISFITS))


def batch_event_date(df: DataFrame) -> DataFrame:
    """One row, ``event_date``: the newest day of the first listed column that has one."""
    present = [c for c in EVENT_DATES if c in df.columns]
    if not present:
        return df.agg(F.lit(None).cast("date").alias("event_date"))
    days = {c: parse_any(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c) for c in present}
    return df.agg(F.coalesce(*[F.max(F.to_date(day)) for day in days.values()]).alias("event_date"))


def bronze_path(root: str, entity: str, ingestion_date: date | str, load_type: str, event_date: date | str | None = None) -> str:
    path = f"{root}/{entity}/ingestion_date={ingestion_date}/load_type={load_type.lower()}"
    return f"{path}/event_date={event_date}" if event_date else path


def log_path(root: str, at: datetime) -> str:
    return f"{root}/{at:%Y/%m/%d}/run-{at:%H%M%S}.log"


def write_to_bronze(root: str, entity: str, df: DataFrame, ingested_at: datetime, load_type: str, system: str) -> int:
    """Lands one batch and returns its row count; an empty batch writes nothing.

    The source is read once, into the staged copy all later steps use: it may change meanwhile, and nothing is
    replaced before the new rows exist. The hash covers the record as delivered. A full load replaces the
    entity, an incremental one only its own partition.
    """
    spark = df.sparkSession
    with staged(df, f"landing-{entity}") as raw:
        return _land(spark, root, entity, raw, ingested_at, load_type, system)


def _land(spark: SparkSession, root: str, entity: str, raw: DataFrame, ingested_at: datetime, load_type: str, system: str) -> int:
    rows = raw.count()
    if rows == 0:
        return 0
    batch = with_parsed_timestamps(add_bronze_metadata(raw, ingested_at, system))
    event_date = batch_event_date(raw).first()["event_date"]
    full = load_type.lower() == "full"
    batch = in_declared_types(batch, declare(spark, root, entity, batch.schema, afresh=full))
    # the folders are equally deep whatever the batch holds: a batch without a date lies in the default folder
    parts = {"ingestion_date": F.lit(ingested_at.date()), "load_type": F.lit(load_type.lower()), "event_date": F.lit(event_date).cast("date")}
    (batch.withColumns(parts).write.mode("overwrite").partitionBy(*parts)
     .option("partitionOverwriteMode", "static" if full else "dynamic").parquet(f"{root}/{entity}"))
    return rows


def delete_entity(spark, root: str, entity: str) -> None:
    files.delete(spark, f"{root}/{entity}")
