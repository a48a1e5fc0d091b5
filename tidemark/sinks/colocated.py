"""Tables dealt by a key when they are written, so that joins, groupings and ranks by that key shuffle nothing.

The catalogue knows into how many buckets a table's rows were dealt by a hash of its key, each sorted by it. Tables with the same number of buckets
meet bucket by bucket. Choose the number for the largest of them: a bucket is what one task holds, and it cannot be changed without writing the table anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import quote_name
from tidemark.session import SHUFFLE_PARTITION_BYTES


def buckets_for(table_bytes: int, bucket_bytes: int = SHUFFLE_PARTITION_BYTES) -> int:
    """A power of two, so that a table twice as large can still meet the old one, two buckets of it with one."""
    return 1 << max(0, (max(1, -(-table_bytes // bucket_bytes)) - 1).bit_length())


def write_colocated(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None, sort_by: Sequence[str] = ()) -> DataFrame:
    """Replaces the table ``name``. Rows are dealt by the key first, so that each bucket is one file and not one for every task."""
    rows = df.repartition(buckets, F.col(quote_name(key)))
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *sort_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_of(spark: SparkSession, name: str) -> int | None:
    """How many buckets the catalogue has for a table."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows and rows[0]["data_type"].isdigit() else None
