"""Reading the tables, and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UNITS = 1_000_003  # steps of a hash

#: Columns of the documents table, in order; every stage of the pipeline but the last keeps them.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def sampled_by_hash(rows: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """About ``size`` rows of each group, chosen by a hash of the key alone: a filter, without a sort or a window.

    There is one count per group; groups are few (languages, labels).
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("_count"))
    share = F.pmod(F.xxhash64(key), F.lit(_UNITS)).cast("double") * F.col("_count") < F.lit(size * _UNITS)
    return rows.join(F.broadcast(counts), group).where(share).drop("_count")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed.

    ``lower`` gives the same for text without other characters and is much cheaper; the rest goes through ``translate``.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
