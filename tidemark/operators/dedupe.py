"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BYTES = 16  # of the usual record hash, 32 hexadecimal digits as text


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order_by``.

    The rank filter lets Spark keep one row per key *before* the shuffle (group limit), so a key that
    holds a large share of the rows sends at most one row per map task.
    """
    ranked = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def packed_hash(text: Column) -> Column:
    """Bytes that sort like the texts and tell them apart: 17 for 32 lower-case hexadecimal digits.

    Any other text stands whole behind the digits next to it, marked as lower (00) or higher (FF) than those.
    """
    digits = F.regexp_extract(text, f"^[0-9a-f]{{0,{2 * HASH_BYTES}}}", 0)
    size = F.length(digits)
    then = F.substring(text, size + 1, F.lit(1))  # is no digit, unless there are too many

    def beside(near: Column, mark: str) -> Column:
        return F.concat(F.unhex(near), F.unhex(F.lit(mark)), text.cast("binary"))

    def filled(start: Column, digit: str) -> Column:
        return F.rpad(start, 2 * HASH_BYTES, digit)
    usual = (F.octet_length(text) == 2 * HASH_BYTES) & (F.lower(F.hex(F.unhex(text))) == text)  # what the first case below says, without a pattern
    return (F.when(usual, F.concat(F.unhex(text), F.unhex(F.lit("80"))))
            .when((size == 2 * HASH_BYTES) & (then == ""), F.concat(F.unhex(digits), F.unhex(F.lit("80"))))
            .when(size == 2 * HASH_BYTES, beside(digits, "FF"))
            .when(then < "0", beside(filled(digits, "0"), "00"))
            .when(then > "f", beside(filled(digits, "f"), "FF"))
            .when(text.isNotNull(), beside(filled(F.concat(digits, F.lit("9")), "f"), "FF")))


def unpacked_hash(packed: Column) -> Column:
    """The text that :func:`packed_hash` was made of."""
    own = F.hex(F.substring(packed, HASH_BYTES + 1, 1)) == "80"
    return F.when(own, F.lower(F.hex(F.substring(packed, 1, HASH_BYTES)))).otherwise(F.substring(packed, HASH_BYTES + 2, 1 << 30).cast("string"))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str = "_ingestion_ts",
                   hash_column: str | None = "_record_hash") -> DataFrame:
    """The newest version of every key; rows of one batch share a timestamp, so the hash breaks ties.

    Hash texts are shuffled packed: random digits don't compress, and take up much of a row.
    """
    newest = F.col(ts).desc_nulls_last()
    if not hash_column:
        return first_per_key(df, keys, [newest])
    if df.schema[hash_column].dataType != T.StringType() or hash_column in (ts, *keys):
        return first_per_key(df, keys, [newest, F.col(hash_column).desc_nulls_last()])
    packed = df.withColumn(hash_column, packed_hash(F.col(hash_column)))
    latest = first_per_key(packed, keys, [newest, F.col(hash_column).desc_nulls_last()])
    return latest.withColumn(hash_column, unpacked_hash(F.col(hash_column)))
