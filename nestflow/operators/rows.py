"""filter, orderBy, groupBy + agg."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.functions.paths import column_at, find_path, sql_text, top
from nestflow.operators.columns import hashable


def filter_rows(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(F.expr(sql_text(df.schema, condition)))


def order_rows(df: DataFrame, columns: Mapping[str, bool], carry: Sequence[str] = ()) -> DataFrame:
    """Sort by ``{column: ascending}``; nulls come first ascending, last descending.

    A sort is range-partitioned on its keys, so all rows of one key value would end
    in one task. The row's hash and the input partition are added as last keys:
    they change nothing in the asked order but let a frequent value spread over
    tasks, copies included, and both are the same again when a task is rerun.
    """
    keys = [top(c).asc() for c in carry]
    for path, ascending in columns.items():
        key = column_at(df.schema, path)
        keys.append(key.asc() if ascending else key.desc())
    names = ["__hash", "__origin"]
    while set(names) & set(df.columns):
        names = [f"_{name}" for name in names]
    values = F.xxhash64(*hashable(df)), F.spark_partition_id()
    spread = dict(zip(names, values, strict=True))
    return df.withColumns(spread).orderBy(*keys, *names).drop(*names)


def aggregate(
    df: DataFrame,
    columns: Sequence[str] | str,
    aggregations: Mapping[str, str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Group by ``columns`` (none: one row) and compute ``{name: SQL aggregate}``.

    Spark combines on the map side first, so a frequent key costs one row per task
    in the shuffle.
    """
    columns = [columns] if isinstance(columns, str) else columns
    keys = [top(c) for c in carry]
    keys += [_key(df, path) for path in columns if path not in carry]
    results = [F.expr(sql_text(df.schema, e)).alias(name) for name, e in aggregations.items()]
    return df.groupBy(*keys).agg(*results)


def _key(df: DataFrame, path: str) -> Column:
    found = find_path(df.schema, path)
    if found is None:
        raise LookupError(f"no column or field {path!r}; columns are {df.columns}")
    return found.column.alias(found.parts[-1])
