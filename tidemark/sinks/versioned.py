"""Keyed tables whose changes become visible all at once.

Below the table's folder lie ``_data/_v=N`` with the rows that version N wrote, partitioned; ``_index/_v=N``, a small table that names the live pieces
(a piece is one partition folder of one version) with lowest and highest key, number of rows and a bitmap of hashed keys; ``_changes/_v=N``, the rows as they were
before and after; and ``_current/N.json``, the pointer. A reader takes the highest pointer and reads the pieces its index names. A writer
puts everything else in place first and the pointer last, so a run that stops anywhere leaves the table as it was, and the next one
writes the same version anew.

A merge reads only pieces whose range and bitmap admit one of the new keys, first their keys and, where one is really there, their rows. Rows of new
keys are added beside the old pieces of their partition; once a partition has ``PIECES`` of them they are joined.

Properties (a small dictionary) are published with a version. A job that keeps in them how far it has read its sources moves rows and marks
in one step. ``changes`` lists what happened since a version, which is what those jobs read instead of the table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace as changed

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quote_name
from tidemark.session import staged
from tidemark.sinks import files

BUCKETS = 32  # a bitmap of 32 768 hashed keys each
PIECES = 8
CHANGE = "_change"  # 'before' or 'after'
NUMBER = "_version"

_BITS = 1 << 15


@dataclass(frozen=True)
class Version:
    path: str
    number: int
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    schema: T.StructType
    properties: dict = field(default_factory=dict)
    all_new: bool = False  # all its rows are its changes, which are not written twice
    listed: tuple[str, ...] | None = None  # columns of its list of changes, if not all

    def folder(self, kind: str, number: int | None = None) -> str:
        return f"{self.path}/_{kind}/_v={self.number if number is None else number}"


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in files.names(spark, f"{path}/_current") if n.endswith(".json")]


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or an older one that was not removed; None before the first."""
    numbers = _numbers(spark, path)
    if not numbers or (number is not None and number not in numbers):
        return None
    number = max(numbers) if number is None else number
    told = json.loads(files.read_text(spark, f"{path}/_current/{number:010d}.json"))
    return Version(path, number, tuple(told["keys"]), tuple(told["partition_by"]), T.StructType.fromJson(told["schema"]), told["properties"], told.get("all_new", False),
                   None if told.get("listed") is None else tuple(told["listed"]))


def _part(name: str) -> str:
    return f"_p_{name}"


def _index(spark: SparkSession, at: Version) -> DataFrame:
    return spark.read.parquet(at.folder("index"))


def _places(index: DataFrame, at: Version) -> list[Row]:
    return index.select("_v", *[_part(p) for p in at.partition_by]).distinct().collect()


def _folder(at: Version, piece: Row) -> str:
    from tidemark.sinks.incremental import folder_value
    return at.folder("data", piece["_v"]) + "".join(f"/{p}={folder_value(piece[_part(p)])}" for p in at.partition_by)


def _read_pieces(spark: SparkSession, at: Version, pieces: Sequence[Row], schema: T.StructType | None = None) -> DataFrame:
    """The rows of some pieces, with the version that wrote each in column ``_v``."""
    schema = schema or at.schema
    wide = T.StructType([f for f in schema.fields if f.name != "_v"] + [T.StructField("_v", T.LongType())])
    if not pieces:
        return spark.createDataFrame([], wide)
    return spark.read.schema(wide).option("basePath", f"{at.path}/_data").parquet(*sorted(_folder(at, p) for p in pieces))


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, number: int | None = None) -> DataFrame | None:
    """The table, in the columns of its newest version or of ``schema``; None before the first version."""
    at = current(spark, path, number)
    if at is None:
        return None
    names = [quote_name(f.name) for f in (schema or at.schema).fields]
    return _read_pieces(spark, at, _places(_index(spark, at), at), schema).select(*names)


def _bit(keys: Sequence[str]) -> Column:
    """A place in the bitmaps; keys are hashed as text, so that a widened type keeps its place."""
    return F.pmod(F.xxhash64(*[F.col(quote_name(k)).cast("string") for k in keys]), F.lit(BUCKETS * _BITS))


def _key_index(rows: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    first = F.col(quote_name(keys[0])) if keys else F.lit(None).cast("string")
    bit = _bit(keys) if keys else F.lit(0).cast("long")
    return (rows.select(*by, first.alias("_key"), bit.alias("_bit"))
            .groupBy(*[c for c in rows.select(*by).columns], F.floor(F.col("_bit") / _BITS).cast("int").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("_bit") % _BITS).alias("bitmap"), F.min("_key").alias("low"), F.max("_key").alias("high"), F.count("*").alias("n")))


def may_hold(index: DataFrame, new: DataFrame, keys: Sequence[str], places: Sequence[str]) -> DataFrame:
    """Pieces whose range and bitmap admit a key of ``new``; the rest cannot hold one."""
    wanted = _key_index(new, keys, []).select("bucket", F.col("bitmap").alias("_wanted"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    apart = F.coalesce((F.col("low") > F.col("_high")) | (F.col("high") < F.col("_low")), F.lit(False))
    both = index.join(F.broadcast(wanted), "bucket").where(~apart)  # at most BUCKETS rows are broadcast
    return (both.select(*places, "bucket", F.explode(F.array("bitmap", "_wanted")).alias("bits"))
            .groupBy(*places, "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("common")).where("common > 0").select(*places).distinct())


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "_k_") -> list[Column]:
    return [left[quote_name(k)].eqNullSafe(right[f"{prefix}{i}"]) for i, k in enumerate(keys)]


def _keys_of(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return rows.select(*[F.col(quote_name(k)).alias(f"_k_{i}") for i, k in enumerate(keys)], *more)


def _publish(spark: SparkSession, at: Version) -> None:
    told = {"keys": at.keys, "partition_by": at.partition_by, "schema": at.schema.jsonValue(), "properties": at.properties, "all_new": at.all_new, "listed": at.listed}
    files.publish_text(spark, f"{at.path}/_current/{at.number:010d}.json", json.dumps(told))


def _write(rows: DataFrame, at: Version, mode: str = "overwrite") -> None:
    from tidemark.sinks.incremental import clustered
    writer = clustered(rows, at.partition_by).write.mode(mode)
    (writer.partitionBy(*at.partition_by) if at.partition_by else writer).parquet(at.folder("data"))


def _written(spark: SparkSession, at: Version) -> DataFrame:
    """What the version has written so far, in the order of its columns."""
    wide = T.StructType([f for f in at.schema.fields if f.name != "_v"])
    return spark.read.schema(wide).parquet(at.folder("data")).select(*[quote_name(f.name) for f in wide.fields])


def _commit(spark: SparkSession, at: Version, rows: DataFrame | None, kept_index: DataFrame | None, images: DataFrame | None,
            properties: Callable[[DataFrame], dict] | None = None, begun: bool = False) -> Version:
    """``properties``, if given, is asked for the written rows. If the version has ``begun``, ``rows`` are added to those it has written."""
    if images is not None:
        images.write.mode("overwrite").parquet(at.folder("changes"))
    else:
        files.delete(spark, at.folder("changes"))
    if rows is not None:
        _write(rows, at, "append" if begun else "overwrite")
    if properties:
        at = changed(at, properties=properties(_written(spark, at)))
    index = _key_index(_written(spark, at), at.keys, [F.lit(at.number).cast("long").alias("_v"), *[F.col(quote_name(p)).alias(_part(p)) for p in at.partition_by]])
    if kept_index is not None:
        index = kept_index.unionByName(index)
    index.coalesce(1).write.mode("overwrite").parquet(at.folder("index"))  # pieces by buckets, whatever the rows
    _publish(spark, at)
    return at


def replace(df: DataFrame, path: str, keys: Sequence[str] = (), partition_by: Sequence[str] = (), properties: dict | None = None) -> Version:
    """A new version that holds ``df`` alone. It has no list of changes: readers of changes start over."""
    spark, before = df.sparkSession, current(df.sparkSession, path)
    at = Version(path, before.number + 1 if before else 1, tuple(keys), tuple(partition_by), df.schema, properties or {})
    return _commit(spark, at, df, None, None)


def _listed(rows: DataFrame, listed: Sequence[str] | None) -> DataFrame:
    """The columns of a list of changes; a row of an older version may lack some."""
    return rows if listed is None else rows.select(*[F.col(quote_name(c)) for c in listed if c in rows.columns])


def _too_many(pieces: Sequence[Row], at: Version) -> list[Row]:
    by_part: dict[tuple, list[Row]] = {}
    for p in pieces:
        by_part.setdefault(tuple(p[_part(n)] for n in at.partition_by), []).append(p)
    return [p for own in by_part.values() if len(own) >= PIECES for p in own]


def merge(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), version: str | None = None,
          properties: dict | Callable[[DataFrame], dict] | None = None, listed: Sequence[str] | None = None) -> Version:
    """One row per key: rows of ``df``, which holds one row per key, replace those with the same key, and the columns follow them.

    With ``version`` a row whose version is older than the stored one changes nothing; no version is the oldest. Without rows there is no new version,
    unless a dictionary of properties is given; a function of the staged new rows is only asked if there are some. Properties are taken over
    where none are given. The rows of a first version are written once, and are its changes. ``listed`` names the columns of the list of changes, where
    its readers need few; all by default.
    """
    spark, before = df.sparkSession, current(df.sparkSession, path)
    listed = None if listed is None else tuple(listed)
    if before is None:
        asked = properties if callable(properties) else None
        at = Version(path, 1, tuple(keys), tuple(partition_by), df.schema, {} if asked else properties or {}, all_new=True, listed=listed)
        return _commit(spark, at, df, None, None, asked)
    fits = before.keys == tuple(keys) and before.partition_by == tuple(partition_by)
    at = Version(path, before.number + 1, before.keys, before.partition_by, df.schema, before.properties, listed=listed)
    if version or not fits:
        with staged(df, "merge-new") as new:
            return _merge(new, at, before, properties, version, fits)
    _write(df, at)  # rows that are all taken are written where they stay
    return _merge(_written(spark, at), at, before, properties, None)


def _merge(new: DataFrame, at: Version, before: Version, properties: dict | Callable[[DataFrame], dict] | None, version: str | None, fits: bool = True) -> Version:
    """The rest of :func:`merge`; without ``version`` the new version holds the rows of ``new``."""
    spark, keys, path, listed, begun = new.sparkSession, at.keys, at.path, at.listed, fits and not version
    if not isinstance(properties, dict) and new.isEmpty():
        if begun:
            files.delete(spark, at.folder("data"))
        return before
    if not fits:
        raise ValueError(f"the table has keys {before.keys} and partitions {before.partition_by}")
    if properties is not None:
        at = changed(at, properties=properties(new) if callable(properties) else properties)
    index, places = _index(spark, before), ["_v", *[_part(p) for p in before.partition_by]]
    candidates = may_hold(index, new, keys, places).collect()
    older = [F.col(quote_name(version)).alias("_stored")] if version else []
    stored = _read_pieces(spark, before, candidates, new.schema)
    wanted = _keys_of(new, keys, *([F.col(quote_name(version)).alias("_arrived")] if version else []))
    found = _keys_of(stored, keys, *older, F.col("_v"), *[F.col(quote_name(p)).alias(_part(p)) for p in before.partition_by])
    met = found.join(wanted.withColumnsRenamed({f"_k_{i}": f"_n_{i}" for i in range(len(keys))}),
                     [F.col(f"_k_{i}").eqNullSafe(F.col(f"_n_{i}")) for i in range(len(keys))]).drop(*[f"_n_{i}" for i in range(len(keys))])
    stale = F.coalesce(F.col("_stored") > F.col("_arrived"), F.col("_stored").isNotNull() & F.col("_arrived").isNull()) if version else F.lit(False)
    with staged(met.withColumn("_stale", stale), "merge-met") as hits:
        touched = hits.where("not _stale").select(*places).distinct().collect()
        if version:
            late = hits.where("_stale")
            new = new.join(late, _same(new, late, keys), "left_anti")
        live = _places(index, before)
        full = [p for p in _too_many(live, before) if p not in touched]
        replaced = hits.where("not _stale").select(*[f"_k_{i}" for i in range(len(keys))])  # fewer than the new keys
        reread = _read_pieces(spark, before, [*touched, *full], new.schema).drop("_v")
        kept = reread.join(replaced, _same(reread, replaced, keys), "left_anti")
        old = _read_pieces(spark, before, touched).drop("_v")
        images = (_listed(old.join(replaced, _same(old, replaced, keys), "left_semi"), listed).withColumn(CHANGE, F.lit("before"))
                  .unionByName(_listed(new, listed).withColumn(CHANGE, F.lit("after")), allowMissingColumns=True))
        gone = spark.createDataFrame([*touched, *full], T.StructType([f for f in index.schema.fields if f.name in places]))
        left = index.join(F.broadcast(gone.withColumnsRenamed({p: f"_g{p}" for p in places})),  # one row a piece
                          [index[p].eqNullSafe(F.col(f"_g{p}")) for p in places], "left_anti") if touched or full else index
        rows = kept.unionByName(new) if not begun else kept if touched or full else None
        return _commit(spark, at, rows, left, images, begun=begun)


def rows_of(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key columns, all or the first ones, are in ``wanted``, which holds each once; of pieces that cannot hold one nothing is read."""
    at = current(spark, path)
    keys = list(wanted.columns)
    index, places = _index(spark, at), ["_v", *[_part(p) for p in at.partition_by]]
    if tuple(keys) == at.keys:
        pieces = may_hold(index, wanted, keys, places).collect()
    elif tuple(keys) == at.keys[:len(keys)]:  # the bitmaps are of whole keys, the range is of the first column
        low, high = wanted.agg(F.min(quote_name(keys[0])), F.max(quote_name(keys[0]))).first()
        pieces = _places(index.where(~F.coalesce((F.col("high") < F.lit(low)) | (F.col("low") > F.lit(high)), F.lit(False))), at)
    else:
        raise ValueError(f"{keys} are not the first of {at.keys}")
    rows = _read_pieces(spark, at, pieces).drop("_v")
    own = _keys_of(wanted, keys)
    return rows.join(own, _same(rows, own, keys), "left_semi")


def changes(spark: SparkSession, path: str, since: int) -> DataFrame | None:
    """Rows before and after (column ``_change``) of every version later than ``since``, with the version in ``_version``.

    They have the columns that the newest version lists. None if a list or a column of it is missing, because the table was replaced or the version is too
    old; then read the whole table.
    """
    at = current(spark, path)
    if at is None or since < 0 or since > at.number:
        return None
    wanted, first = [f"_v={n}" for n in range(since + 1, at.number + 1)], None
    if since == 0 and (start := current(spark, path, 1)) is not None and start.all_new:
        first = _listed(read(spark, path, at.schema, 1), at.listed).select("*", F.lit("after").alias(CHANGE), F.lit(1).cast("long").alias(NUMBER))
        wanted = wanted[1:]
    if set(wanted) - set(files.names(spark, f"{path}/_changes")):
        return None
    own = [f for f in at.schema.fields if at.listed is None or f.name in at.listed]
    told = [current(spark, path, int(v.removeprefix("_v="))) for v in wanted]
    if any(v is None or (v.listed is not None and {f.name for f in own if f.name in v.schema.names} - set(v.listed)) for v in told):
        return None
    schema = T.StructType([*own, T.StructField(CHANGE, T.StringType()), T.StructField("_v", T.LongType())])
    if not wanted:
        return spark.createDataFrame([], schema).withColumnRenamed("_v", NUMBER) if first is None else first
    paths = [f"{path}/_changes/{v}" for v in wanted]
    later = spark.read.schema(schema).option("basePath", f"{path}/_changes").parquet(*paths).withColumnRenamed("_v", NUMBER)
    return later if first is None else first.unionByName(later)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes what the newest ``keep`` versions do not need, and what broken runs left beyond the newest."""
    numbers = sorted(_numbers(spark, path))
    if not numbers:
        return
    kept = [current(spark, path, n) for n in numbers[-keep:]]
    needed = {_folder(at, p) for at in kept for p in _places(_index(spark, at), at)}
    for n in numbers[:-keep]:
        files.delete(spark, f"{path}/_current/{n:010d}.json")
    for kind in ("index", "changes"):
        for name in files.names(spark, f"{path}/_{kind}"):
            if int(name.removeprefix("_v=")) not in numbers[-keep:]:
                files.delete(spark, f"{path}/_{kind}/{name}")

    def clear(folder: str) -> None:
        if folder in needed:
            return
        if any(n.startswith(f"{folder}/") for n in needed):
            for name in files.subfolders(spark, folder):
                clear(f"{folder}/{name}")
        else:
            files.delete(spark, folder)
    for name in files.names(spark, f"{path}/_data"):
        clear(f"{path}/_data/{name}")
