"""Text, keys and names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_hash(c: Column) -> Column:
    return F.md5(c.cast("string"))


def surrogate_key(columns: Sequence[Column]) -> Column:
    """md5 of the values joined by ``-``; NULL and the empty string give the same key."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def concat(columns: Sequence[Column]) -> Column:
    """NULL when any part is NULL."""
    return F.concat(*columns)


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def bool_to_text(c: Column) -> Column:
    return c.cast("string")


def safe_cast(c: Column, type_name: str) -> Column:
    """NULL instead of an error when the value does not fit the type."""
    return c.try_cast(type_name)


def right(c: Column, n: Column) -> Column:
    """Last ``n`` characters; the empty string for ``n`` up to 0."""
    return F.right(c, n)


# Portable type names and their Spark types.
TYPES = {
    "string": "string",
    "timestamp": "timestamp",
    "float": "float",
    "numeric": "decimal(38,6)",
    "bigint": "bigint",
    "int": "int",
}


def type_name(portable: str) -> str:
    return TYPES[portable]


def quote_name(name: str) -> str:
    """A column name that may hold dashes, dots or blanks, quoted for use in expressions."""
    return "`" + name.replace("`", "``") + "`"


def slugify(name: str) -> str:
    """A column name from free text: lower case, blanks and dashes to underscores, the rest dropped."""
    name = re.sub(r"[ -]+", "_", name.lower())
    return re.sub(r"[^a-z0-9_]+", "", name)


def slugify_column(c: Column) -> Column:
    """:func:`slugify` on values."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[ -]+", "_"), r"[^a-z0-9_]+", "")
