"""Vector columns: which rows count, whole numbers of their entries, and their blocks as NumPy arrays.

A shorter vector counts as followed by zeros. Whole numbers beyond 64 bits stay at the ends of their range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_VALUES = 1 << 20  # entries handled at once


def is_whole(vector: Column) -> Column:
    """The vector is there, and every entry is a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * entry) of every entry, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def padded(vector: Column, size: int) -> Column:
    return F.when(F.size(vector) < size, F.concat(vector, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(vector)))).otherwise(vector)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column without nulls as rows of ``size`` whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == size * len(column):
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        if (lengths == size).all():
            return flat.reshape(len(column), size)
    out = np.zeros((len(column), size), np.int64)
    for i, row in enumerate(column.to_pylist()):
        out[i, :len(row)] = row
    return out


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``BLOCK_VALUES`` entries, at least one row."""
    rows = max(1, BLOCK_VALUES // max(size, 1))
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def reduced(rows: DataFrame, merge: Callable[[pa.Table], pa.Table], fan: int = 16) -> DataFrame:
    """The rows (column ``part``: 0, 1, ...) brought together ``fan`` at a time until one is left, always in the same order."""
    last = rows.agg(F.max("part")).first()[0]
    columns = [F.col(f.name) for f in rows.schema.fields if f.name != "part"]

    def one(table: pa.Table) -> pa.Table:
        return merge(table.sort_by("part"))

    while last:
        rows = (rows.select("part", F.floor(F.col("part") / fan).cast("long").alias("_group"), *columns)
                .groupBy("_group").applyInArrow(one, rows.schema))
        last //= fan
        rows = rows.select("part", *columns)
    return rows
