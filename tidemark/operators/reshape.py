"""Column selection, pivots, superset unions and generated rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import eq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quote_name


def filtered_columns(df: DataFrame, except_: Iterable[str] = ()) -> list[str]:
    """Column names without the excluded ones (any case)."""
    dropped = {e.lower() for e in except_}
    return [c for c in df.columns if c.lower() not in dropped]


def star(df: DataFrame, except_: Iterable[str] = (), prefix: str = "", suffix: str = "") -> list[Column]:
    """All columns but some, optionally renamed with a prefix and a suffix."""
    return [F.col(quote_name(c)).alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, except_)]


def pivot(column: Column, values: Sequence, agg: Callable[[Column], Column] = F.sum,
          cmp: Callable[[Column, Column], Column] = eq, then_value: Column | int = 1,
          else_value: Column | int | None = 0, prefix: str = "", suffix: str = "",
          alias: bool = True) -> list[Column]:
    """One conditional aggregate per value, for ``groupBy(..).agg(*pivot(..))``.

    Unlike ``groupBy.pivot`` a value without rows gives ``else_value`` and any comparison may be used.
    """
    out = []
    for value in values:
        hit = F.when(cmp(column, F.lit(value)), then_value)
        if else_value is not None:
            hit = hit.otherwise(else_value)
        c = agg(hit)
        out.append(c.alias(f"{prefix}{value}{suffix}") if alias else c)
    return out


def unpivot(df: DataFrame, exclude: Sequence[str] = (), remove: Sequence[str] = (), cast_to: str = "string",
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """One row per remaining column, all values cast to one type (booleans to ``true``/``false``)."""
    names = filtered_columns(df, [*exclude, *remove])
    kept = [F.col(quote_name(c)) for c in exclude]
    cast = df.select(*kept, *[F.col(quote_name(c)).cast(cast_to).alias(c) for c in names])
    return cast.unpivot(kept, [F.col(quote_name(c)) for c in names], field_name, value_name)


def union_relations(relations: dict[str, DataFrame], column_override: dict[str, str] | None = None,
                    include: Sequence[str] = (), exclude: Sequence[str] = (),
                    source_column_name: str | None = "source_relation", where: str | None = None) -> DataFrame:
    """Union over the superset of columns, in the order first seen; absent columns are NULL.

    ``relations`` maps the name written to ``source_column_name`` to its rows. The type of a column is that
    of its first relation unless overridden.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = column_override or {}

    def wanted(name: str) -> bool:
        return name in include if include else name not in exclude

    types: dict[str, T.DataType | str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            if wanted(f.name):
                types.setdefault(f.name, override.get(f.name, f.dataType))
    if not types:
        raise ValueError("no columns left to union")
    parts = []
    for name, df in relations.items():
        df = df.where(where) if where else df
        source = [F.lit(name).alias(source_column_name)] if source_column_name else []
        parts.append(df.select(*source, *[
            (F.col(quote_name(c)) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]))
    return reduce(DataFrame.unionAll, parts)


def null_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings to NULL in the given (default: all) text columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(quote_name(c)), F.lit("")) for c in text
                           if columns is None or c in columns})


def snake_case(df: DataFrame) -> DataFrame:
    """Dashes in column names to underscores."""
    return df.withColumnsRenamed({c: c.replace("-", "_") for c in df.columns if "-" in c})


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    """Rows 1..n in ``generated_number``."""
    if n <= 0:
        raise ValueError("n must be positive")
    return spark.range(1, n + 1).withColumnRenamed("id", "generated_number")


REPEAT_CHUNK = 100_000


def series_per_row(df: DataFrame, upper: Column, name: str = "generated_number", chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row repeated for 1..upper; rows with upper below 1 drop out.

    A large count is cut into chunks that are spread over the tasks, so one row never fills a task by itself.
    """
    first, here = F.col("_chunk") * chunk + 1, F.least((F.col("_chunk") + 1) * chunk, F.col("_times"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("_times") / chunk) - 1)
    spread = (df.withColumn("_times", upper.cast("bigint")).where("_times > 0")
              .withColumn("_chunk", F.explode(chunks)).repartition(F.xxhash64(*[F.col(quote_name(c)) for c in df.columns], "_chunk")))
    return spread.withColumn(name, F.explode(F.sequence(first, here))).drop("_times", "_chunk")


def repeat_rows(df: DataFrame, times: Column, chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row repeated ``times`` times."""
    return series_per_row(df, times, "_i", chunk).drop("_i")


# The date parts a spine may step by.
SPINE_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


def date_spine(bounds: DataFrame, datepart: str, start: Column, end: Column, name: str | None = None,
               chunk: int = REPEAT_CHUNK) -> DataFrame:
    """One row per part from ``start`` up to but not including ``end``.

    ``bounds`` is a one-row frame (or one row per group) that ``start`` and ``end`` refer to.
    """
    if datepart not in SPINE_PARTS:
        raise ValueError(f"unknown date part {datepart!r}")
    name = name or f"date_{datepart}"
    begin, stop = start.cast("timestamp"), end.cast("timestamp")
    spans = bounds.withColumns({"_begin": begin, "_stop": stop}).where("_begin < _stop")
    unit = datepart.upper()
    # whole parts that fit, and one more that may begin before the end; their number is spread over the tasks
    counted = series_per_row(spans, F.timestamp_diff(unit, F.col("_begin"), F.col("_stop")) + 1, "_nth", chunk)
    at = F.timestamp_add(unit, (F.col("_nth") - 1).cast("int"), F.col("_begin"))
    return counted.withColumn(name, at).where(F.col(name) < F.col("_stop")).drop("_begin", "_stop", "_nth")


def tables_like(spark: SparkSession, database: str, pattern: str, exclude: str = "") -> list[str]:
    """Tables and views of a database whose name matches an ``ilike`` pattern, sorted."""
    names = [t.name for t in spark.catalog.listTables(database)]
    if not names:
        return []
    listed = spark.createDataFrame([(n,) for n in names], "name string").where(F.col("name").ilike(pattern))
    if exclude:
        listed = listed.where(~F.col("name").ilike(exclude))
    return sorted(r["name"] for r in listed.collect())  # catalogue entries only


def tables_with_prefix(spark: SparkSession, database: str, prefix: str, exclude: str = "") -> list[str]:
    return tables_like(spark, database, f"{prefix}%", exclude)


def results_as_dict(df: DataFrame) -> dict[str, list]:
    """``{column: values}`` of a result that the caller knows to be small, as a report or a list of settings.

    To filter a table by a result, keep the result a DataFrame and use :func:`tidemark.operators.joins.matching`.
    """
    rows = df.collect()
    return {c: [r[i] for r in rows] for i, c in enumerate(df.columns)}


def column_values(df: DataFrame, column: str, order_by: Sequence[Column] | None = None,
                  max_records: int | None = None, where: str | None = None) -> DataFrame:
    """Distinct values with their counts, most frequent first; ``max_records`` makes it a top-k report."""
    df = df.where(where) if where else df
    counted = df.groupBy(F.col(quote_name(column)).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    ranked = counted.orderBy(*(order_by or [F.desc("n_rows"), F.asc_nulls_last("value")]))
    return ranked.limit(max_records) if max_records else ranked


def table_column_values(spark: SparkSession, table: str, column: str, default: Sequence | None = None,
                        max_records: int | None = None, **options) -> list:
    """:func:`column_values` of a catalogue table as a list; ``default`` when the table does not exist."""
    if not spark.catalog.tableExists(table):
        if default is None:
            raise ValueError(f"table {table!r} does not exist")
        return list(default)
    values = column_values(spark.table(table), column, max_records=max_records, **options)
    return results_as_dict(values)["value"]
