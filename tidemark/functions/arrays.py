"""Array values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_construct(columns: Sequence[Column], type_name: str = "int") -> Column:
    return F.array(*columns) if columns else F.array().cast(f"array<{type_name}>")


def array_append(array: Column, element: Column) -> Column:
    return F.array_append(array, element)


def array_concat(first: Column, second: Column) -> Column:
    return F.concat(first, second)


def array_to_text(array: Column) -> Column:
    """``[1,2,3]`` without blanks."""
    return F.concat(F.lit("["), F.array_join(array.cast("array<string>"), ","), F.lit("]"))
