"""Join by ranges: each pair meets in a cell of the ranges' own size.

A condition ``lo of one side <= hi of the other`` in both directions gives each row a range,
which may be a single point. A range belongs to the level whose cells, of a power of two in
size, are just as long, so that it touches two of them at most. Two ranges meet on the higher
level of theirs, in the first cell that both touch: a row is copied once or twice for each level
that the other side has above its own. Cells with very many rows or pairs are cut by a hash of
the rows, and their other side's rows are copied to all parts; the parts go to as many tasks as
their pairs need, which the bytes of the rows do not tell. The condition itself is checked again
on each pair of a cell, so that rounding loses and adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.paths import top
from nestflow.operators.columns import hashable

#: Sizes of cells differ by this power of two from level to level.
LEVEL_BITS = 2
#: Rows of a cell that stay together, and the most parts that a cell is cut into.
CELL_ROWS = 10_000
MOST_PARTS = 64
#: Pairs of a cell that stay together, the most parts that they cut a side into, and the pairs
#: and the most tasks of a join.
CELL_PAIRS = 2_000_000
MOST_PAIR_PARTS = 10_000
TASK_PAIRS = 10_000_000
MOST_TASKS = 20_000
_LARGEST = 9e18

_COMPARISON = re.compile(r"(.*?)\s*(<=|>=|<|>)\s*(.*)", re.S)
_BETWEEN = re.compile(r"(.*?)\s+between\s+(.*)", re.S | re.I)
_RANGED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def conjuncts(text: str) -> list[str]:
    """The parts of a condition between its outermost ``and``s; those of ``between`` stay."""
    parts, start, depth, i = [], 0, 0, 0
    while i < len(text):
        char = text[i]
        if char in "'\"`":
            i = _after_quoted(text, i)
            continue
        depth += (char in "([") - (char in ")]")
        if depth == 0 and (word := re.compile(r"\s(and|or)\s", re.I).match(text, i)):
            if word[1].lower() == "or":
                # Binds less than and: the parts are no conditions of their own.
                return [text.strip()]
            if not _BETWEEN.fullmatch(text[start:i].strip()) or " and " in _last(text[start:i]):
                parts.append(text[start:i])
                start = i + len(word[0]) - 1
            i += len(word[0]) - 1
            continue
        i += 1
    parts = [part.strip() for part in (*parts, text[start:])]
    whole = [_unwrapped(part) for part in parts]
    made: list[str] = []
    for part, own in zip(parts, whole, strict=True):
        made += conjuncts(own) if own != part else [part]
    return made


def _last(text: str) -> str:
    """What follows the last ``between``, in lower case."""
    return re.split(r"\bbetween\b", text.lower())[-1]


def _after_quoted(text: str, at: int) -> int:
    quote, i = text[at], at + 1
    while i < len(text) and text[i] != quote:
        i += 2 if text[i] == "\\" and quote != "`" else 1
    return i + 1


def _unwrapped(text: str) -> str:
    """A condition without the parentheses that are around all of it."""
    if not (text.startswith("(") and text.endswith(")")):
        return text
    depth, i = 0, 0
    while i < len(text):
        if text[i] in "'\"`":
            i = _after_quoted(text, i)
            continue
        depth += (text[i] == "(") - (text[i] == ")")
        if depth == 0 and i < len(text) - 1:
            return text
        i += 1
    return text[1:-1].strip()


def sides_of(text: str) -> set[str]:
    """Which of the sides ``l`` and ``r`` an expression names, outside of literals."""
    text = re.sub(r"'(?:[^'\\]|\\.)*'", " ", text)
    return {name.lower() for name in re.findall(r"(?<![\w.`])([lr])\.", text, re.I)}


def ranges(parts: Sequence[str]) -> tuple[tuple[str, str], tuple[str, str]] | None:
    """Expressions of the low and high end of ``l`` and of ``r`` by the conditions, or null."""
    ends: dict[str, tuple[str, str]] = {}
    for part in parts:
        for low, high in _at_most(part):
            one, other = sides_of(low), sides_of(high)
            if len(one) == len(other) == 1 and one != other:
                ends.setdefault(one.pop(), (low, high))
    if len(ends) < 2:
        return None
    return (ends["l"][0], ends["r"][1]), (ends["r"][0], ends["l"][1])


def _at_most(part: str) -> list[tuple[str, str]]:
    """Pairs of expressions of which the first is not above the second."""
    if match := _BETWEEN.fullmatch(part):
        low, high = re.split(r"\s+and\s+", match[2], maxsplit=1, flags=re.I)
        return [(low, match[1]), (match[1], high)]
    match = _COMPARISON.fullmatch(part)
    if not match or re.search(r"[<>=!]", match[3]) or re.search(r"\bnot\b|\bor\b", part, re.I):
        return []
    low, sign, high = match.groups()
    return [(low, high) if sign[0] == "<" else (high, low)]


def meet(left: DataFrame, right: DataFrame, condition: Column, found) -> DataFrame:
    """Pairs of rows, as ``l`` and ``r``, that meet the condition; ``found`` is of ``ranges``."""
    sides = []
    for df, name, (low, high) in zip((left, right), "lr", found, strict=True):
        df = df.alias(name).withColumns({"__low": F.expr(low), "__high": F.expr(high)})
        for column in ("__low", "__high"):
            if not isinstance(df.schema[column].dataType, _RANGED):
                raise ValueError(f"{low}..{high} is no range of numbers, days or times")
        sides.append(_ranged(df))
    levels = [_levels(df) for df in sides]
    known = [level for own in levels for level in own if level is not None]
    # Points have no size; they go with the shortest ranges.
    least = min(known, default=0)
    levels = [{least if level is None else level for level in own} for own in levels]
    cells = [
        _cells(df, least, sorted(other)) for df, other in zip(sides, reversed(levels), strict=True)
    ]
    counts = _counts(*cells)
    tasks = _tasks(counts)
    cut, copied = _parts(*cells, counts)
    if tasks > 1:
        # By number, as adaptive execution would gather tasks by their few bytes.
        place = ["__level", "__cell", "__part"]
        cut, copied = cut.repartition(tasks, *place), copied.repartition(tasks, *place)
    on = F.col("l.__level") == F.col("r.__level")
    on &= (F.col("l.__cell") == F.col("r.__cell")) & (F.col("l.__part") == F.col("r.__part"))
    once = F.greatest("l.__own", "r.__own") == F.col("l.__level")
    once &= F.greatest("l.__first", "r.__first") == F.col("l.__cell")
    return cut.alias("l").join(copied.alias("r"), on & once & condition, "inner")


def _ranged(df: DataFrame) -> DataFrame:
    """The ends as numbers, the smaller one first; rows without ends match nothing."""

    def number(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.DateType):
            return F.unix_date(name).cast("double")
        if isinstance(kind, T.TimestampNTZType):
            return F.unix_micros(F.col(name).cast("timestamp")) / 1e6
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(name) / 1e6
        return F.nanvl(F.col(name).cast("double"), F.lit(1e300))

    low, high = F.lit(-1e300), F.lit(1e300)
    ends = [F.greatest(F.least(number(n), high), low) for n in ("__low", "__high")]
    df = df.filter("__low IS NOT NULL AND __high IS NOT NULL")
    df = df.withColumns({"__low": F.least(*ends), "__high": F.greatest(*ends)})
    size = F.col("__high") - F.col("__low")
    level = F.ceil(F.log2(F.when(size > 0, size)) / LEVEL_BITS).cast("int")
    return df.withColumn("__own", level)


def _levels(df: DataFrame) -> set[int | None]:
    """The levels of a side's rows, of which there are a few hundred at most; null for points."""
    return {row[0] for row in df.select("__own").distinct().collect()}


def _cells(df: DataFrame, least: int, others: list[int]) -> DataFrame:
    """A row for each cell that a row touches, on its level and on the other side's above it."""
    own = F.coalesce(F.col("__own"), F.lit(least))
    above = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda level: level > own)
    levels = F.concat(F.array(own), above)

    def cell(name: str, level: Column) -> Column:
        place = F.col(name) / F.pow(F.lit(2.0), level * LEVEL_BITS)
        return F.floor(F.greatest(F.least(place, F.lit(_LARGEST)), F.lit(-_LARGEST)))

    def touched(level: Column) -> Column:
        first = cell("__low", level)
        # A range is no longer than a cell of its level.
        last = F.least(cell("__high", level), first + 1)
        return F.transform(
            F.sequence(first, last),
            lambda c: F.struct(level.alias("level"), c.alias("cell"), first.alias("first")),
        )

    df = df.withColumn("__own", own)
    df = df.withColumn("__touched", F.explode(F.flatten(F.transform(levels, touched))))
    named = {f"__{name}": F.col(f"__touched.{name}") for name in ("level", "cell", "first")}
    return df.withColumns(named).drop("__touched", "__low", "__high")


def _counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of both sides in each cell."""
    place = ["__level", "__cell"]
    counts = [
        df.groupBy(*place).agg(F.count(F.lit(1)).alias(name))
        for df, name in ((left, "l_rows"), (right, "r_rows"))
    ]
    return counts[0].join(counts[1], place, "full").fillna(0, ["l_rows", "r_rows"])


def _tasks(counts: DataFrame) -> int:
    """How many tasks the pairs of all cells need."""
    # In doubles, as the pairs may be more than a long holds.
    pairs = F.sum(F.col("l_rows").cast("double") * F.col("r_rows"))
    total = counts.agg(pairs.alias("pairs")).first()["pairs"] or 0.0
    return int(min(total / TASK_PAIRS + 1, MOST_TASKS))


def _parts(
    left: DataFrame, right: DataFrame, counts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides, the rows of full cells cut into parts."""
    place = ["__level", "__cell"]
    by_rows = [
        F.greatest(F.least(F.ceil(F.col(n) / CELL_ROWS), F.lit(MOST_PARTS)), F.lit(1)).alias(name)
        for n, name in (("l_rows", "__l_parts"), ("r_rows", "__r_parts"))
    ]
    full = counts.select(*place, "l_rows", "r_rows", *by_rows)
    # What that leaves of pairs in a part, cut on the side of more rows.
    pairs = F.col("l_rows").cast("double") * F.col("r_rows")
    more = F.ceil(pairs / F.col("__l_parts") / F.col("__r_parts") / CELL_PAIRS)
    more = F.greatest(F.least(more, F.lit(MOST_PAIR_PARTS)), F.lit(1))
    larger = F.col("l_rows") >= F.col("r_rows")
    full = full.select(
        *place,
        (F.col("__l_parts") * F.when(larger, more).otherwise(1)).alias("__l_parts"),
        (F.col("__r_parts") * F.when(larger, 1).otherwise(more)).alias("__r_parts"),
    ).filter("__l_parts > 1 OR __r_parts > 1")
    return _copied(left, full, "l"), _copied(right, full, "r")


def _copied(df: DataFrame, full: DataFrame, name: str) -> DataFrame:
    """Rows with the parts that they go to: a part is one of the own side's and one of the
    other's, so a row goes to as many as the other side is cut into."""
    plain = [top(c) for c in df.columns]
    df = df.join(full, ["__level", "__cell"], "left").fillna(1, ["__l_parts", "__r_parts"])
    mine, other = (F.col(f"__{n}_parts") for n in (name, "r" if name == "l" else "l"))
    own = F.pmod(F.xxhash64(*hashable(df), F.spark_partition_id()), mine)

    def part(number: Column) -> Column:
        return own * other + number if name == "l" else number * mine + own

    numbers = F.sequence(F.lit(0).cast("bigint"), other.cast("bigint") - 1)
    return df.withColumn("__part", F.explode(F.transform(numbers, part))).select(*plain, "__part")
