"""Landed folders as catalogue tables, one partition a folder.

The catalogue says which folders are known, so a registration only looks into new ones, and any session on the same catalogue reads the table.
Partitions point at their folders; nothing is copied. Columns that new folders bring are added to the table and are NULL in older folders.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quote_name
from tidemark.sinks import files

EXCLUDED_FOLDERS = ("tmp",)  # fixed value: folders of unfinished work; markers and manifests are no Parquet files
_BATCH = 200  # partitions added by one statement


def _leaves(spark: SparkSession, folder: str, parts: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Partition folders below ``folder`` as the names on the way to them."""
    below = [n for n in files.subfolders(spark, folder) if "=" in n and n not in EXCLUDED_FOLDERS]
    if not below:
        if parts:
            yield parts
        return
    for name in below:
        yield from _leaves(spark, f"{folder}/{name}", (*parts, name))


def _partition_types(spark: SparkSession, base: str, leaf: tuple[str, ...]) -> dict[str, T.DataType]:
    names = [p.split("=", 1)[0] for p in leaf]
    schema = spark.read.option("basePath", base).option("pathGlobFilter", "*.parquet").parquet(f"{base}/{'/'.join(leaf)}").schema
    return {n: T.DateType() if n.endswith("_date") else schema[n].dataType for n in names}


def _columns(spark: SparkSession, base: str, leaves: list[tuple[str, ...]]) -> list[T.StructField]:
    """Columns of the files in these folders; Spark merges their footers in tasks."""
    reader = spark.read.option("mergeSchema", True).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return reader.parquet(*[f"{base}/{'/'.join(leaf)}" for leaf in leaves]).schema.fields


def known_partitions(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    """What the catalogue lists, as the names of the folders."""
    return {tuple(r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _spec(leaf: tuple[str, ...]) -> str:
    values = (p.split("=", 1) for p in leaf)
    return ", ".join(f"{quote_name(n)} = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else "'" + _unescaped(v).replace("\\", "\\\\").replace("'", "\\'") + "'") for n, v in values)


def _unescaped(value: str) -> str:
    from urllib.parse import unquote
    return unquote(value)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, root: str, entity: str, table: str) -> list[str]:
    """Registers the folders of ``root/entity`` that the catalogue does not list yet and returns them."""
    base = f"{root}/{entity}"
    leaves = sorted(_leaves(spark, base))
    exists = spark.catalog.tableExists(table)
    known = known_partitions(spark, table) if exists else set()
    fresh = [leaf for leaf in leaves if tuple(leaf) not in known]
    if not fresh:
        return []
    parts = [p.split("=", 1)[0] for p in fresh[0]]
    columns = [f for f in _columns(spark, base, fresh) if f.name not in parts]
    if not exists:
        kinds = _partition_types(spark, base, fresh[0])
        described = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in columns)
        partitioned = ", ".join(f"{quote_name(n)} {t.simpleString()}" for n, t in kinds.items())
        spark.sql(f"CREATE TABLE {table} ({described}, {partitioned}) USING parquet PARTITIONED BY ({', '.join(map(quote_name, parts))}) LOCATION {_quoted(base)}")
    else:
        have = {n.lower() for n in spark.table(table).columns}
        added = [f for f in columns if f.name.lower() not in have]
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{quote_name(f.name)} {f.dataType.simpleString()}' for f in added)})")
    for first in range(0, len(fresh), _BATCH):
        clauses = " ".join(f"PARTITION ({_spec(leaf)}) LOCATION {_quoted(base + '/' + '/'.join(leaf))}" for leaf in fresh[first:first + _BATCH])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
    spark.catalog.refreshTable(table)
    return ["/".join(leaf) for leaf in fresh]


def deregister_missing(spark: SparkSession, root: str, entity: str, table: str) -> list[str]:
    """Drops partitions whose folders are gone, as after a full load; the files are not touched."""
    there = set(_leaves(spark, f"{root}/{entity}")) if files.exists(spark, f"{root}/{entity}") else set()
    gone = sorted(known_partitions(spark, table) - there)
    for leaf in gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(leaf)})")
    return ["/".join(leaf) for leaf in gone]


def landed_table(spark: SparkSession, table: str) -> DataFrame:
    """The table without manifests and the like that lie in its folders; Spark itself only leaves out names with a leading ``_`` or dot."""
    return spark.table(table).where(F.col("_metadata.file_name").endswith(".parquet"))
