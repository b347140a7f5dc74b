"""join and union with other inputs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.functions.paths import quote_path, top
from nestflow.operators.columns import hashable
from nestflow.operators.ranges import conjuncts, meet, ranges

# Spellings of a join type, without underscores.
JOIN_TYPES = {
    "inner": "inner",
    "cross": "inner",  # with keys to match on, cross gives what inner gives
    "left": "left_outer",
    "leftouter": "left_outer",
    "right": "right_outer",
    "rightouter": "right_outer",
    "outer": "full_outer",
    "full": "full_outer",
    "fullouter": "full_outer",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}
# A key is hot if it holds more than one row in so many: there are fewer hot keys than that.
HOT_SHARE = 1000
# And more rows than this, which a task joins in no time.
LEAST_HOT = 10_000

_COMPARES = re.compile(r"[=<>]|\s")
_EQUALITY = re.compile(r"\s*([lr])\.([^\s=]+)\s*=\s*([lr])\.([^\s=]+)\s*", re.I)


def join_input(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salt: int | None = None,
    hot_share: int = HOT_SHARE,
    least_hot: int | None = None,
) -> DataFrame:
    """Join on key names, or on conditions between the sides ``l`` and ``r``.

    A condition needs an equality ``l.x = r.y`` among its parts that ``and`` combines, or bounds
    of one side by the other in both directions, such as ``l.x between r.low and r.high``: else
    it would compare every row with every row.

    Which side is broadcast is left to Spark, which knows the sizes. Adaptive execution
    splits a hot key of either side in an inner join, but only of the kept side in an outer
    one, and none in a full one. So an outer join first counts the keys of the sides that it
    cannot split. Rows of keys with more than one row in ``hot_share``, and more than
    ``least_hot`` rows, go through an inner join, and those of a full join that match nothing are added; without such keys nothing
    changes. ``salt=n`` cuts the left side's hot keys into n parts in an inner join, for
    sessions without adaptive execution.
    """
    least_hot = LEAST_HOT if least_hot is None else least_hot
    kind = JOIN_TYPES.get(how.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"unknown join type {how!r}; known are {sorted(JOIN_TYPES)}")
    on = [on] if isinstance(on, str) else list(on)
    if any(_COMPARES.search(item) for item in on):
        if salt:
            raise ValueError("salt needs key names, not a condition")
        return _join_where(left, right, on, kind, hot_share, least_hot)
    if kind in ("left_semi", "left_anti"):
        # Only the keys matter: fold the right side's copies before the shuffle.
        right = right.select(*[top(k) for k in on]).distinct()
        return left.join(right, on, kind)
    if kind == "inner":
        return _join_inner(left, right, on, salt, hot_share)
    hot = _hot_of_unsplit(left, right, on, on, kind, hot_share, least_hot)
    if hot is None:
        return left.join(right, on, kind)
    kept = _cold(left, hot, on).join(_cold(right, hot, on), on, kind)
    left, right = left.join(hot, on, "left_semi"), right.join(hot, on, "left_semi")
    joined = kept.union(_join_inner(left, right, on, salt, hot_share))
    if kind == "full_outer":
        for side, other in ((left, right), (right, left)):
            keys = other.select(*[top(k) for k in on]).distinct()
            alone = side.join(keys, on, "left_anti")
            columns = [top(k) for k in on]
            for own in (left, right):
                rest = [f for f in own.schema.fields if f.name not in on]
                columns += [
                    top(f.name) if own is side else F.lit(None).cast(f.dataType) for f in rest
                ]
            joined = joined.union(alone.select(*columns))
    return joined


def _hot_of_unsplit(left, right, left_on, right_on, kind, hot_share, least) -> DataFrame | None:
    """Hot keys, named as the left's, of the sides that an outer join of that kind keeps
    whole; null if there are none. They are fewer than 2 * ``hot_share``, in the type that
    both sides' keys have in common."""
    found = []
    if kind in ("right_outer", "full_outer"):
        found.append(_hot_keys(left, left_on, hot_share, least))
    if kind in ("left_outer", "full_outer"):
        found.append(_hot_keys(right, right_on, hot_share, least).toDF(*left_on))
    # Spark's types of a union; a side without rows brings its own.
    typed = left.select(*[top(k) for k in left_on]).limit(0)
    typed = typed.union(right.select(*[top(k) for k in right_on]).limit(0))
    hot = reduce(DataFrame.union, found, typed).distinct()
    # A key that is null matches nothing.
    rows = [tuple(row) for row in hot.collect() if None not in tuple(row)]
    return F.broadcast(left.sparkSession.createDataFrame(rows, hot.schema)) if rows else None


def _cold(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    return df.join(hot, on, "left_anti")


def _join_where(
    left: DataFrame, right: DataFrame, on: list[str], kind: str, hot_share: int, least: int
) -> DataFrame:
    parts = [part for item in on for part in conjuncts(item)]
    pairs = [m.groups() for part in parts if (m := _EQUALITY.fullmatch(part))]
    pairs = [p for p in pairs if p[0].lower() != p[2].lower()]
    condition = reduce(Column.__and__, [F.expr(f"({item})") for item in on])
    if not pairs:
        found = ranges(parts)
        if found is None:
            raise ValueError(
                f"join condition {on} has no equality l.x = r.y of its own, nor bounds in both "
                "directions: it would compare every row with every row"
            )
        return _from_pairs(left, right, meet(left, right, condition, found), kind)
    if kind in ("left_semi", "left_anti"):
        return left.alias("l").join(right.alias("r"), condition, kind)
    sides = [{p[0].lower(): p[1], p[2].lower(): p[3]} for p in pairs]
    left_on, right_on = ([side[s].strip("`") for side in sides] for s in "lr")
    hot = None
    known = set(left_on) <= set(left.columns) and set(right_on) <= set(right.columns)
    for side in (left, right):
        known = known and len(hashable(side)) == len(side.columns)
    if kind != "inner" and known:
        hot = _hot_of_unsplit(left, right, left_on, right_on, kind, hot_share, least)
    if hot is None:
        return _joined_where(left, right, condition, kind)
    met = left.alias("l").join(right.alias("r"), condition, "inner")
    return _from_pairs(left, right, met, kind)


def _from_pairs(left: DataFrame, right: DataFrame, met: DataFrame, kind: str) -> DataFrame:
    """The join of that kind by its pairs, rows ``l`` and ``r``: the rows that are in no pair are
    told by their contents, as equal rows are in the same pairs."""
    if kind in ("left_semi", "left_anti"):
        names = met.select(*_row_names(left, "l.")).distinct()
        kept = left.select("*", *_row_names(left)).join(names, ROW_NAMES, kind)
        return kept.select(*[top(c) for c in left.columns])
    joined = met.select(*_both(left, right))
    for side, name, keeps in (
        (left, "l", ("left_outer", "full_outer")),
        (right, "r", ("right_outer", "full_outer")),
    ):
        if kind in keeps:
            names = met.select(*_row_names(side, f"{name}.")).distinct()
            mine = side.select("*", *_row_names(side))
            alone = mine.join(names, ROW_NAMES, "left_anti").drop(*ROW_NAMES)
            if name == "r":
                renamed = [top(c).alias(n) for c, n in _right_names(left, right)]
                alone = alone.select(*renamed)
            joined = joined.unionByName(alone, allowMissingColumns=True)
    return joined


ROW_NAMES = ["__row", "__row_too"]


def _row_names(df: DataFrame, prefix: str = "") -> list[Column]:
    """Two hashes of a row, together as good as the row itself; nulls are told apart."""
    columns = [F.col(prefix + quote_path([c])) for c in df.columns]
    parts = [x for c in columns for x in (c, c.isNull())]
    hashes = F.xxhash64(*parts), F.xxhash64(F.lit(1), *reversed(parts))
    return [h.alias(n) for h, n in zip(hashes, ROW_NAMES, strict=True)]


def _right_names(left: DataFrame, right: DataFrame) -> list[tuple[str, str]]:
    """A name both sides have is kept from the left; the right's gets a prefix."""
    taken, names = {c.lower() for c in left.columns}, []
    free = {c.lower() for c in right.columns} | taken
    for column in right.columns:
        name = column
        while name.lower() in taken or (name != column and name.lower() in free):
            name = f"r_{name}"
        taken.add(name.lower())
        names.append((column, name))
    return names


def _joined_where(left: DataFrame, right: DataFrame, condition: Column, kind: str) -> DataFrame:
    joined = left.alias("l").join(right.alias("r"), condition, kind)
    return joined.select(*_both(left, right))


def _both(left: DataFrame, right: DataFrame) -> list[Column]:
    columns = [F.col(f"l.{quote_path([c])}") for c in left.columns]
    return columns + [
        F.col(f"r.{quote_path([c])}").alias(n) for c, n in _right_names(left, right)
    ]


def _join_inner(
    left: DataFrame, right: DataFrame, on: list[str], salt: int | None, hot_share: int
) -> DataFrame:
    if not salt:
        return left.join(right, on, "inner")
    hot = F.broadcast(_hot_keys(left, on, hot_share).withColumn("__hot", F.lit(True)))
    # Hash and input partition together spread copies too, and survive a rerun.
    part = F.pmod(F.xxhash64(*hashable(left), F.spark_partition_id()), F.lit(salt))
    salted = left.join(hot, on, "left").withColumn(
        "__salt", F.when(F.col("__hot"), part).otherwise(0)
    )
    parts = F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))
    copies = F.when(F.col("__hot"), parts).otherwise(F.array(F.lit(0).cast("bigint")))
    repeated = right.join(hot, on, "left").withColumn("__salt", F.explode(copies))
    joined = salted.drop("__hot").join(repeated.drop("__hot"), [*on, "__salt"], "inner")
    return joined.select(*_using_columns(left, right, on))


def _hot_keys(df: DataFrame, on: list[str], hot_share: int, least: int = 0) -> DataFrame:
    counts = df.groupBy(*[top(k) for k in on]).agg(F.count(F.lit(1)).alias("__rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    hot = counts.filter(F.col("__rows") * hot_share > total)
    return hot.filter(F.col("__rows") > least).select(*[top(k) for k in on])


def _using_columns(left: DataFrame, right: DataFrame, on: list[str]) -> list[Column]:
    rest = [c for c in left.columns + right.columns if c not in on]
    return [top(c) for c in [*on, *rest]]


def union_input(df: DataFrame, other: DataFrame, by_name: bool = False) -> DataFrame:
    """Append rows by position, or by name with nulls for what one side lacks."""
    return df.unionByName(other, allowMissingColumns=True) if by_name else df.union(other)
