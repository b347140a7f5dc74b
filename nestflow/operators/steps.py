"""Fold a step list over a DataFrame.

Nothing runs until the result is used, but for what joins ask first: an outer join counts the
keys of a side, a join by ranges looks up the sizes of its ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from nestflow.operators.columns import explode_column, select_columns, with_column
from nestflow.operators.combine import join_input, union_input
from nestflow.operators.rows import aggregate, filter_rows, order_rows
from nestflow.operators.validate import StepError, check_steps


def apply_steps(
    df: DataFrame,
    steps: Sequence[dict],
    inputs: Mapping[str, DataFrame] | None = None,
    missing: str = "error",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Apply ``steps`` in order.

    ``inputs`` names the DataFrames that join and union may use; with only one,
    a step need not name it. ``missing`` is the default for select. Columns in
    ``carry`` go through every step and are part of every grouping and sort, so
    that with the source file among them many files are flattened at once, each
    as if it were alone. Right and full joins and unions add rows of no file; with
    ``carry`` they are refused. An ``agg`` without groups has no row for a file without rows.
    """
    inputs = inputs or {}
    check_steps(steps, inputs.keys(), in_job=bool(carry))
    group: Sequence[str] | str = ()
    for number, step in enumerate(steps, start=1):
        operation = step["operation"]
        try:
            if operation == "groupBy":
                group = step["columns"]
            elif operation == "agg":
                df, group = aggregate(df, group, step["aggregations"], carry), ()
            else:
                df = _apply(df, operation, step, inputs, missing, carry)
        except (LookupError, ValueError, AnalysisException) as error:
            raise StepError(number, operation, str(error)) from error
    return df


def _apply(df, operation, step, inputs, missing, carry) -> DataFrame:
    match operation:
        case "select":
            # YAML reads a bare ``null`` as none.
            absent = step.get("missing", missing) or "null"
            return select_columns(df, step["columns"], absent, carry)
        case "explode":
            options = {k: step[k] for k in ("keep", "outer") if k in step}
            return explode_column(df, step["column"], step["alias"], carry=carry, **options)
        case "filter":
            return filter_rows(df, step["condition"])
        case "join":
            options = {k: step[k] for k in JOIN_OPTIONS if k in step}
            return join_input(df, _input(step, inputs), step["on"], **options)
        case "union":
            return union_input(df, _input(step, inputs), step.get("by_name", False))
        case "orderBy":
            return order_rows(df, step["columns"], carry)
        case "distinct":
            return df.distinct()
        case "withColumn":
            return with_column(df, step)


JOIN_OPTIONS = ("how", "salt", "hot_share", "least_hot")


def _input(step: Mapping, inputs: Mapping[str, DataFrame]) -> DataFrame:
    return inputs[step["with"]] if "with" in step else next(iter(inputs.values()))
