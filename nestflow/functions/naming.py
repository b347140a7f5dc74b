"""Columns derived from a file's path: technology, market, day, output name."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded(path: Column) -> Column:
    """A file path as written on disk; Spark reports it with ``%20`` and the like."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    # Most paths need none, and each row has one.
    return F.when(F.contains(path, F.lit("%")), plain).otherwise(path)


def clean_prefix(prefix: str) -> str:
    return prefix.strip("/")


def tech_of(path: Column, prefixes: Mapping[str, str]) -> Column:
    """Technology whose prefix is the first, in configured order, to occur in the path.

    The prefixes are configuration, so they are compiled into one CASE expression:
    no join, no shuffle. A path that holds none of them gives null.
    """
    result = F.lit(None).cast("string")
    for tech, prefix in reversed(list(prefixes.items())):
        hit = F.contains(path, F.lit(clean_prefix(prefix)))
        result = F.when(hit, F.lit(tech)).otherwise(result)
    return result


def market_of(path: Column, template: str) -> Column:
    """The text that stands at ``{}`` of the bucket template; null when there is none."""
    if "{}" not in template:
        return F.lit(None).cast("string")
    before, after = _without_scheme(template).split("{}", 1)
    pattern = re.escape(before) + "([^/]+?)" + re.escape(after.rstrip("/")) + "/"
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def day_of(path: Column) -> dict[str, Column]:
    """``year``, ``month`` and ``day`` as the folders in the path write them, or null."""
    pattern = r"year=(\d{4})/month=(\d{1,2})/day=(\d{1,2})(?:/|$)"
    return {
        name: F.nullif(F.regexp_extract(path, pattern, i), F.lit(""))
        for i, name in enumerate(("year", "month", "day"), start=1)
    }


def output_name(path: Column) -> Column:
    """Base name with its ``.xml`` suffix, and only the suffix, turned to ``.parquet``; a
    compressed file's ``.xml.gz`` as well."""
    base = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(base, r"\.xml(\.gz)?$", ".parquet")


def _without_scheme(uri: str) -> str:
    return re.sub(r"^[a-z][a-z0-9+.-]*:/+", "/", uri)
