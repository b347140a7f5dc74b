"""select, explode and withColumn."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.paths import Found, find_path, quote_path, sql_text, top


def hashable(df: DataFrame) -> list[Column]:
    """The columns a hash can be taken of; a constant when there are none."""
    return [top(f.name) for f in df.schema.fields if not _holds_map(f.dataType)] or [F.lit(0)]


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def select_columns(
    df: DataFrame, columns: Mapping[str, str], missing: str = "error", carry: Sequence[str] = ()
) -> DataFrame:
    """Project ``{source path: target name}`` in the order written.

    ``p.*`` puts the fields of a struct in place, or one row per element for an
    array of structs. ``missing="null"`` gives a null string for an absent path,
    and no column for an absent ``p.*``.
    """
    out = [top(name) for name in carry]
    for source, target in columns.items():
        path = source.removesuffix(".*")
        found = find_path(df.schema, path)
        if path != source:
            if found is not None or missing != "null":
                out.extend(_expand_star(df, path, taken=set(carry)))
        elif target in carry:
            if source != target:
                raise LookupError(f"the name {target!r} is taken by a carried column")
        elif found is not None:
            out.append(found.column.alias(target))
        elif missing == "null":
            out.append(F.lit(None).cast("string").alias(target))
        else:
            raise LookupError(f"no column or field {source!r}; columns are {df.columns}")
    return df.select(*out)


def _expand_star(df: DataFrame, path: str, taken: set[str]) -> list[Column]:
    found = find_path(df.schema, path)
    if found is None:
        raise LookupError(f"no column or field {path!r}; columns are {df.columns}")
    struct = found.type.elementType if isinstance(found.type, T.ArrayType) else found.type
    names = [n for n in struct.names if n not in taken] if isinstance(struct, T.StructType) else []
    if isinstance(found.type, T.StructType):
        return [F.col(f"{found.sql}.{quote_path([n])}").alias(n) for n in names]
    if isinstance(found.type, T.ArrayType) and isinstance(found.type.elementType, T.StructType):
        if names == struct.names:
            return [F.inline(found.column)]
        fields = lambda e: F.struct(*[e[n].alias(n) for n in names])
        return [F.inline(F.transform(found.column, fields))]
    raise LookupError(f"{path!r} is {found.type.simpleString()}, which has no fields to expand")


def explode_column(
    df: DataFrame,
    column: str,
    alias: str,
    keep: bool = False,
    outer: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per element of an array, or per entry of a map.

    Only the element is left unless ``keep`` is set. ``outer`` keeps a row for a
    null or empty collection. What is neither array nor map counts as an array of
    one, since an XML element that occurs once is not read as an array.
    """
    found = find_path(df.schema, column)
    if found is None:
        raise LookupError(f"no column or field {column!r}; columns are {df.columns}")
    names = [f"{alias}_key", f"{alias}_value"] if isinstance(found.type, T.MapType) else [alias]
    rest = df.columns if keep else list(carry)
    generate = F.explode_outer if outer else F.explode
    exploded = generate(_collection(found)).alias(*names)
    return df.select(*[top(c) for c in rest if c not in names], exploded)


def _collection(found: Found) -> Column:
    if isinstance(found.type, (T.ArrayType, T.MapType)):
        return found.column
    return F.when(found.column.isNotNull(), F.array(found.column))


def with_column(df: DataFrame, step: Mapping) -> DataFrame:
    """Add or replace a column by a literal ``value`` or a SQL ``func`` text."""
    if "value" in step:
        return df.withColumn(step["column"], F.lit(step["value"]))
    if "func" in step:
        return df.withColumn(step["column"], F.expr(sql_text(df.schema, step["func"])))
    return df
