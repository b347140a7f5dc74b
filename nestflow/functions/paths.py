"""Resolve dotted paths such as ``a.b:c._id`` against a DataFrame's schema.

XML names hold colons, and flat columns may hold dots, so neither ``col(path)``
nor a SQL string can be handed a path as it is written. Here a path is matched
against the schema once, on the driver, and comes back with every part quoted.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Found(NamedTuple):
    """The quoted parts of a path and the type of what it points at."""

    parts: tuple[str, ...]
    type: T.DataType

    @property
    def sql(self) -> str:
        return quote_path(self.parts)

    @property
    def column(self) -> Column:
        return F.col(self.sql)


def quote_path(parts) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def top(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col(quote_path([name]))


def find_path(schema: T.StructType, path: str) -> Found | None:
    """Find ``path``; a column of exactly that name wins over a nested field."""
    return _descend(schema, path.replace("`", ""), inside_array=False)


def column_at(schema: T.StructType, path: str) -> Column:
    """The column at ``path``, or an error that lists the nearest names."""
    found = find_path(schema, path)
    if found is None:
        raise LookupError(f"no column or field {path!r}; columns are {schema.names}")
    return found.column


def _descend(dtype: T.DataType, path: str, inside_array: bool) -> Found | None:
    if isinstance(dtype, T.StructType):
        return _in_struct(dtype, path, inside_array)
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        return None if inside_array else Found((path,), dtype.valueType)
    if isinstance(dtype, T.ArrayType) and not inside_array:
        # A field of an array of structs is the array of that field.
        found = _descend(dtype.elementType, path, inside_array=True)
        return found and Found(found.parts, T.ArrayType(found.type, True))
    return None


def _in_struct(struct: T.StructType, path: str, inside_array: bool) -> Found | None:
    for fold in (str, str.lower):  # exact names first, then Spark's case-insensitive ones
        wanted = fold(path)
        for field in struct.fields:
            if fold(field.name) == wanted:
                return Found((field.name,), field.dataType)
        # Names may hold dots themselves: try the longest ones first.
        for field in sorted(struct.fields, key=lambda f: -len(f.name)):
            if wanted.startswith(fold(field.name) + "."):
                rest = path[len(field.name) + 1 :]
                found = _descend(field.dataType, rest, inside_array)
                if found is not None:
                    return Found((field.name, *found.parts), found.type)
    return None


_CALLS = re.compile(
    r"""\bcol\(\s*(?P<q>['"])(?P<path>.+?)(?P=q)\s*\)"""
    r"""|\blit\(\s*(?P<value>'[^']*'|"[^"]*"|[-+\w.]+)\s*\)"""
    r"""|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`""",
    re.S,
)


def sql_text(schema: T.StructType, text: str) -> str:
    """SQL for an expression that may use ``col('x')`` and ``lit(1)`` calls.

    The result is plain Spark SQL text for ``expr``; nothing is evaluated in Python.
    """

    def plain(match: re.Match) -> str:
        if match["path"] is not None:
            found = find_path(schema, match["path"])
            return found.sql if found else quote_path(match["path"].split("."))
        # Texts and names in quotes stay, whatever they hold.
        return match[0] if match["value"] is None else match["value"]

    return _CALLS.sub(plain, text)
