from __future__ import annotations

import pytest
from pyspark.sql import types as T

from nestflow.functions import column_at, find_path, sql_text


@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL(
        """
        `xn:Net._id` string, `xn:Net` struct<_id: string, `xn:Me`: array<struct<
            _id: string, tags: array<struct<name: string>>>>>,
        info map<string, struct<a: int>>, plain int, `a.b` struct<c: int>, Upper int
        """
    )


@pytest.mark.parametrize(
    "path, sql, dtype",
    [
        ("plain", "`plain`", "int"),
        ("xn:Net._id", "`xn:Net._id`", "string"),  # the flat column wins
        ("xn:Net.xn:Me", "`xn:Net`.`xn:Me`", None),
        ("xn:Net.xn:Me._id", "`xn:Net`.`xn:Me`.`_id`", "array<string>"),
        ("a.b.c", "`a.b`.`c`", "int"),
        ("info.key", "`info`.`key`", "struct<a:int>"),
        ("upper", "`Upper`", "int"),
    ],
)
def test_finds(schema, path, sql, dtype):
    found = find_path(schema, path)
    assert found.sql == sql
    assert dtype is None or found.type.simpleString() == dtype


@pytest.mark.parametrize("path", ["none", "plain.x", "xn:Net.none", "xn:Net.xn:Me.tags.name"])
def test_does_not_find(schema, path):
    # The last one goes through two arrays: it has to be exploded first.
    assert find_path(schema, path) is None


def test_error_names_the_columns(schema):
    with pytest.raises(LookupError, match="no column or field 'none'.*plain"):
        column_at(schema, "none")


@pytest.mark.parametrize(
    "text, sql",
    [
        ("col('plain') * 2", "`plain` * 2"),
        ('col("xn:Net.xn:Me")', "`xn:Net`.`xn:Me`"),
        ("col('later.x') + lit(1)", "`later`.`x` + 1"),
        ("concat(lit('a b'), col('plain'))", "concat('a b', `plain`)"),
        ("protocol('x')", "protocol('x')"),
        ("plain > 50", "plain > 50"),
        ("concat('col(\'x\')', \"lit(1)\", `col('y')`)", "concat('col(\'x\')', \"lit(1)\", `col('y')`)"),
    ],
)
def test_sql_text(schema, text, sql):
    assert sql_text(schema, text) == sql
