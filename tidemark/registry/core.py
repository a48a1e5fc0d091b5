"""Registration of named queries and assembly of their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.registry.tables_sql import TABLES
from tidemark.sources.bronze import Lake

AS_OF = "2001-08-02"  # fixed value: the day after the last order

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
BODIES: dict[str, str] = {}  # the SQL without the shared tables


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def publish(df: DataFrame) -> DataFrame:
    """Types both engines print alike: zone-less timestamps, doubles for decimals."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            casts[f.name] = "timestamp_ntz"
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = "double"
    return df.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in casts.items()})


def needed_tables(sql: str) -> list[str]:
    """Names of the shared SQL tables used by ``sql``, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(TABLES[name])
                if name not in ordered:
                    ordered.append(name)
    visit(sql)
    return ordered


def full_sql(body: str) -> str:
    """``body`` preceded by the shared tables it names."""
    body = body.strip()
    ctes = [f"{name} AS ({TABLES[name].strip()})" for name in needed_tables(body)]
    if re.match(r"(?i)with\s", body):
        if ctes:
            body = re.sub(r"(?i)^with\s+", "WITH " + ",\n".join(ctes) + ",\n", body, count=1)
        return body
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def query(name: str, sql: str | None = None):
    """Register ``function(lake) -> DataFrame`` under ``name`` with the SQL that gives the same rows."""
    def wrap(function: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return publish(function(Lake(spark, folder)))
        QUERIES[name] = run
        if sql is not None:
            SQL[name], BODIES[name] = full_sql(sql), sql
        return function
    return wrap
