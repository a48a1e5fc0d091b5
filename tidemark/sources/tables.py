"""The given star-schema tables, one Parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import spare_disk, use_utc


class StarTables:
    """Lazy readers for the tables of one folder; ``StarTables(spark, dir).read("orders")``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spare_disk(use_utc(spark))
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """Zone-less timestamps become UTC timestamps, which epoch arithmetic and windows need."""
        df = self.spark.read.parquet(self.path(name))
        return df.withColumns({
            field.name: F.col(field.name).cast("timestamp")
            for field in df.schema.fields
            if isinstance(field.dataType, T.TimestampNTZType)
        })
