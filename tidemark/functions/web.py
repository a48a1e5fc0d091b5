"""Parts of a URL, also of one without a scheme (the built-in parser gives NULL there)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The scheme prefixes that are stripped.
WEB_SCHEMES = ["http://", "https://"]
HOST_SCHEMES = ["android-app://", *WEB_SCHEMES]


def _strip(url: Column, prefixes: list[str]) -> Column:
    for p in prefixes:
        url = F.replace(url, F.lit(p), F.lit(""))
    return url


def _before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))


def url_host(url: Column) -> Column:
    return _before(_before(_strip(url, HOST_SCHEMES), "/"), "?")


def url_path(url: Column) -> Column:
    """Text after the first slash up to the question mark.

    Without a slash the cut is placed just before the question mark, which leaves an empty path; without
    either, the whole text is returned.
    """
    bare = _strip(url, WEB_SCHEMES)
    slash, question = F.position(F.lit("/"), bare), F.position(F.lit("?"), bare)
    start = F.coalesce(F.nullif(slash, F.lit(0)), question - 1)
    return _before(F.right(bare, F.length(bare) - start), "?")


def url_parameter(url: Column, name: str) -> Column:
    """Value of a query parameter, NULL when absent or empty."""
    return F.nullif(_before(F.split_part(url, F.lit(f"{name}="), F.lit(2)), "&"), F.lit(""))
