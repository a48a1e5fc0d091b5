"""Loading a table period by period, each period whole or not at all.

A period is a folder of its own, ``_start=<its first instant>``, and counts once its completion record ``_periods/<start>.json`` is there, which is written after
its rows. A run that stops inside a period leaves a folder without record: it is not read, and the next run replaces it. The record holds the bounds and
the number of rows, so a period cut short by the stop of a run (or by now) is known to be open and is loaded again by a later run.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import aware
from tidemark.sinks import files
from tidemark.sinks.incremental import add_periods

_NAME = "%Y%m%dT%H%M%S.%f"


def _name(at: datetime) -> str:
    return at.astimezone(timezone.utc).strftime(_NAME)


def completed(spark: SparkSession, path: str) -> dict[str, dict]:
    """Completion records by period."""
    names = [n for n in files.names(spark, f"{path}/_periods") if n.endswith(".json")]
    return {n[:-5]: json.loads(files.read_text(spark, f"{path}/_periods/{n}")) for n in names}


def read_periods(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The rows of all completed periods; None before the first."""
    done = completed(spark, path)
    if not done:
        return None
    schema = schema or T.StructType.fromJson(json.loads(files.read_text(spark, f"{path}/_schema.json")))
    folders = sorted(f"{path}/_rows/{r['folder']}" for r in done.values() if r["rows"])
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def load_periods(spark: SparkSession, build: Callable[[Column], DataFrame], path: str, ts: str, start: datetime, stop: datetime,
                 period: str = "week") -> list[datetime]:
    """Loads the periods from ``start`` to ``stop`` (exclusive) that are not complete, and returns their starts.

    ``build(inside)`` gives the rows of one period; ``inside`` is a plain range on ``ts``, first instant included, last excluded, that reaches the scan.
    """
    begin, end, done = aware(start), aware(stop), completed(spark, path)
    loaded, i = [], 0
    while (low := add_periods(begin, i, period)) < end:
        i += 1
        whole = add_periods(begin, i, period)
        high = min(whole, end)
        name = _name(low)
        if name in done and done[name]["until"] >= _name(high):
            continue
        rows = build((F.col(ts) >= F.lit(low)) & (F.col(ts) < F.lit(high)))
        if not files.exists(spark, f"{path}/_schema.json"):
            files.publish_text(spark, f"{path}/_schema.json", rows.schema.json())
        folder = f"start={name}/until={_name(high)}"  # a longer load of the same period stands beside the shorter until its record says so
        rows.write.mode("overwrite").parquet(f"{path}/_rows/{folder}")
        n = spark.read.schema(rows.schema).parquet(f"{path}/_rows/{folder}").count()
        _record(spark, path, name, {"until": _name(high), "rows": n, "folder": folder})
        if name in done:
            files.delete(spark, f"{path}/_rows/{done[name]['folder']}")
        loaded.append(low)
    return loaded


def _record(spark: SparkSession, path: str, name: str, told: dict) -> None:
    """A record is replaced by a newer one of the same period; between both steps the period is open and is loaded again."""
    at = f"{path}/_periods/{name}.json"
    files.delete(spark, at)
    files.publish_text(spark, at, json.dumps(told))
