from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from nestflow import StepError, apply_steps
from nestflow.operators import combine
from nestflow.operators import ranges as range_joins
from nestflow.operators.ranges import conjuncts
from tests.conftest import rows

LEFT = [(1, "a"), (1, "b"), (2, "c"), (4, "d"), (None, "e")]
RIGHT = [(1, 10), (1, 11), (2, 20), (3, 30), (None, 40)]


@pytest.fixture
def left(spark):
    return spark.createDataFrame(LEFT, "k int, l string")


@pytest.fixture
def right(spark):
    return spark.createDataFrame(RIGHT, "k int, r int")


def join(left, right, **options):
    step = {"operation": "join", "on": "k"} | options
    return apply_steps(left, [step], inputs={"other": right})


INNER = [(1, "a", 10), (1, "a", 11), (1, "b", 10), (1, "b", 11), (2, "c", 20)]
LEFT_ONLY = [(4, "d", None), (None, "e", None)]
RIGHT_ONLY = [(3, None, 30), (None, None, 40)]
EXPECTED = {
    "inner": INNER,
    "cross": INNER,
    "left_outer": INNER + LEFT_ONLY,
    "left": INNER + LEFT_ONLY,
    "right_outer": INNER + RIGHT_ONLY,
    "full_outer": INNER + LEFT_ONLY + RIGHT_ONLY,
    "left_semi": LEFT[:3],
    "anti": LEFT[3:],
}


@pytest.mark.parametrize("salt", [None, 4])
@pytest.mark.parametrize("how", EXPECTED)
def test_join_types(left, right, how, salt):
    out = join(left, right, how=how, **({"salt": salt} if salt else {}))
    assert out.columns == (["k", "l"] if how in ("left_semi", "anti") else ["k", "l", "r"])
    assert rows(out) == sorted(EXPECTED[how], key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
def test_salt_changes_no_result(spark, how):
    left = spark.sql("SELECT if(id % 3 = 0, 7, id) AS k, id % 5 AS l FROM range(3000)")
    right = spark.sql("SELECT if(id % 4 = 0, 7, id) AS k, id AS r FROM range(2, 40)")
    assert rows(join(left, right, how=how, salt=5)) == rows(join(left, right, how=how))


def test_salt_spreads_a_frequent_key(spark):
    # Too few bytes for adaptive splitting, so what spreads the key is the salt.
    left = spark.sql("SELECT if(id % 3 = 0, 7, -id) AS k, id AS l FROM range(0, 30000, 1, 8)")
    right = spark.sql("SELECT id AS k, id AS r FROM range(30000)")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        plain, salted = (
            join(left, right, **options)
            .selectExpr("k", "l", "spark_partition_id() AS task")
            .groupBy("task")
            .count()
            .agg({"count": "max"})
            .collect()[0][0]
            for options in ({}, {"salt": 8})
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert plain == 10_000
    assert salted < 6_000


def test_condition(left, right):
    out = join(left, right, on="l.k = r.k AND r.r > 10", how="left_outer")
    assert out.columns == ["k", "l", "r_k", "r"]
    assert rows(out) == sorted(
        [(1, "a", 1, 11), (1, "b", 1, 11), (2, "c", 2, 20), (4, "d", None, None)]
        + [(None, "e", None, None)],
        key=repr,
    )


def test_condition_as_list_and_semi(left, right):
    out = join(left, right, on=["l.k = r.k", "l.l = 'a' OR r.r = 20"], how="left_semi")
    assert rows(out) == [(1, "a"), (2, "c")]


@pytest.mark.parametrize("on", ["l.k < r.k", "l.k = r.k OR r.r = 3", "l.k = 1", ["l.k <= r.k"]])
def test_condition_without_equality_is_refused(left, right, on):
    with pytest.raises(StepError, match="every row with every row"):
        join(left, right, on=on)


def test_or_beside_an_equality(left, right):
    on = "l.k = r.k and (r.r > 15 or l.l = 'a and b')"
    assert rows(join(left, right, on=on)) == [(2, "c", 2, 20)]


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("l.a = r.b and (l.x = 5 or r.y = 7)", ["l.a = r.b", "l.x = 5 or r.y = 7"]),
        ("l.x between r.lo and r.hi AND l.k = 'a and b'", ["l.x between r.lo and r.hi", "l.k = 'a and b'"]),
        ("(l.x >= r.lo and l.`a and b` < r.hi)", ["l.x >= r.lo", "l.`a and b` < r.hi"]),
        ("l.a = 1 or l.b = 2", ["l.a = 1 or l.b = 2"]),
        ("((l.a = r.a) and f(r.x and r.y) = 1)", ["l.a = r.a", "f(r.x and r.y) = 1"]),
    ],
)
def test_parts_of_a_condition(text, parts):
    assert conjuncts(text) == parts


RANGES = (
    "l.x BETWEEN r.lo AND r.hi",
    "r.lo - 2 <= l.x and r.lo + 2 > l.x",
    "l.x <= r.hi and l.x + 3 >= r.lo",  # both sides have a length
)


@pytest.mark.parametrize("on", RANGES)
@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
def test_join_by_ranges(spark, on, how):
    r = random.Random(7)
    odd = [None, 1e308, float("nan"), float("-inf"), 5.0, 5.0]
    points = [(i, r.choice(odd) if i % 5 == 0 else r.uniform(-30, 30)) for i in range(80)]
    lows = [r.uniform(-40, 40) for _ in range(60)]
    spans = [(i, a, r.choice([a, a + 20 * r.random() ** 4, a - 1, None, float("inf")])) for i, a in enumerate(lows)]
    left = spark.createDataFrame([*points, points[3]], "id int, x double")
    right = spark.createDataFrame([*spans, spans[4]], "rid int, lo double, hi double")
    kind = {"semi": "left_semi", "anti": "left_anti", "full": "full_outer"}.get(how, how)
    plain = left.alias("l").join(right.alias("r"), F.expr(on), kind)
    assert [*map(str, rows(join(left, right, on=on, how=how)))] == [*map(str, rows(plain))]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(9,2)", "bigint"])
def test_types_of_ranges(spark, kind):
    made = "date'2031-02-07' + cast(id AS int)" if "dec" not in kind and kind != "bigint" else "id"
    left = spark.sql(f"SELECT id, cast({made} AS {kind}) AS x FROM range(50)")
    right = left.selectExpr("id AS rid", "x AS lo").filter("rid % 3 = 0")
    right = right.join(left.selectExpr("id - 2 AS rid", "x AS hi"), "rid")
    on = "l.x >= r.lo AND l.x < r.hi"
    plain = left.alias("l").join(right.alias("r"), F.expr(on))
    assert rows(join(left, right, on=on)) == rows(plain) and plain.count() == 32
    if kind == "date":
        texts = left.selectExpr("id", "cast(x AS string) AS x")
        with pytest.raises(StepError, match="no range of numbers, days or times"):
            join(texts, right.selectExpr("rid", "string(lo) AS lo", "string(hi) AS hi"), on=on)


def test_full_cells_of_a_join_by_ranges_are_cut(spark, monkeypatch):
    """Half of the rows lie in one cell: no part of it has a third of them, and no pair is lost."""
    monkeypatch.setattr(range_joins, "CELL_ROWS", 500)
    left = spark.sql("SELECT id, if(id % 2 = 0, 5.5D, id / 7) AS x FROM range(0, 20000, 1, 8)")
    right = spark.sql("SELECT id AS rid, id / 1D AS lo, id + 0.75D AS hi FROM range(3000)")
    on = "l.x >= r.lo AND l.x < r.hi"
    found = join(left, right, on=on)
    plain = left.alias("l").join(right.alias("r"), F.expr("floor(l.x) = r.rid AND " + on))
    sums = F.count(F.lit(1)), F.sum("id"), F.sum("rid")
    assert found.agg(*sums).first() == plain.agg(*sums).first()
    sides = range_joins.ranges(range_joins.conjuncts(on))
    met = range_joins.meet(left, right, F.expr(on), sides)
    parts = met.groupBy("l.__level", "l.__cell", "l.__part").count()
    assert parts.agg(F.max("count")).first()[0] < 20_000 / 3
    # Pairs outside a cell are never made.
    assert "Cartesian" not in (plan := met._jdf.queryExecution().toString()) and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_hot_keys_of_another_type(spark, how):
    left = spark.sql("SELECT 7 AS k, id AS l FROM range(300) UNION ALL SELECT 1, -1")
    right = spark.sql("SELECT 5000000000 AS k, id AS r FROM range(300) UNION ALL SELECT 1L, -1L")
    for one, other in ((left, right), (right, left)):
        plain = rows(one.join(other, "k", how))
        assert rows(join(one, other, how=how, least_hot=100)) == plain


def test_unknown_type(left, right):
    with pytest.raises(StepError, match="unknown join type 'sideways'"):
        join(left, right, how="sideways")


def test_several_keys_and_named_input(spark, left):
    other = spark.createDataFrame([(1, "a", 5), (1, "x", 6)], "k int, l string, v int")
    out = apply_steps(
        left,
        [{"operation": "join", "with": "b", "on": ["k", "l"]}],
        inputs={"a": left, "b": other},
    )
    assert rows(out) == [(1, "a", 5)]


CONDITION = ["l.k = r.k", "r.r < 300000"]
OUTER = [
    (how, on, hot) for how in ("left", "right", "full") for on in ("k", CONDITION) for hot in "lr"
]


@pytest.mark.parametrize(("how", "on", "hot"), OUTER)
def test_a_hot_key_of_either_side_is_split(spark, tmp_path, monkeypatch, how, on, hot):
    """Half of the rows of a side have one key: no task gets more than a third of them."""
    monkeypatch.setattr(combine, "LEAST_HOT", 100)
    many = "SELECT if(id % 2 = 0, 7, -id) AS k, id AS {} FROM range(0, 400000, 1, 8)"
    few = "SELECT id AS k, id AS {} FROM range(0, 2000, 1, 4)"
    left = spark.sql((many if hot == "l" else few).format("l"))
    right = spark.sql((few if hot == "l" else many).format("r"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = join(left, right, on=on, how=how)
        if len(out.columns) == 4:
            out = out.selectExpr("coalesce(k, r_k) AS k", "l", "r")
        # Grouping by the key right here would forbid the split.
        out.withColumn("task", F.spark_partition_id()).write.parquet(str(tmp_path / "out"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    condition = "l.k = r.k" + (" AND r.r < 300000" if on != "k" else "")
    left.createOrReplaceTempView("join_l")
    right.createOrReplaceTempView("join_r")
    want = spark.sql(
        f"SELECT coalesce(l.k, r.k) AS k, l, r FROM join_l l {how} JOIN join_r r ON {condition}"
    )
    got = spark.read.parquet(str(tmp_path / "out"))
    sums = F.count(F.lit(1)), F.sum("l"), F.sum("r"), F.count("l"), F.count("r")
    by_key, wanted = got.groupBy("k").agg(*sums), want.groupBy("k").agg(*sums)
    assert by_key.exceptAll(wanted).count() == 0 and by_key.count() == wanted.count()
    most = got.filter("k = 7").groupBy("task").count().agg(F.max("count")).first()[0]
    assert most <= 200_000 / 3


def test_outer_joins_without_a_hot_key_stay_as_they_are(spark, left, right):
    plan = join(left, right, how="full")._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join") == 1


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_split_joins_keep_duplicate_names_and_nulls(spark, monkeypatch, left, right, how):
    plain = rows(join(left, right.withColumnRenamed("r", "l"), how=how))
    monkeypatch.setattr(combine, "LEAST_HOT", 1)
    assert rows(join(left, right.withColumnRenamed("r", "l"), how=how)) == plain
    on = ["l.k = r.k"]
    split = join(left, right, on=on, how=how)
    monkeypatch.undo()
    assert split.columns == ["k", "l", "r_k", "r"]
    assert rows(split) == rows(join(left, right, on=on, how=how))


def test_names_of_a_condition_join(spark):
    left = spark.createDataFrame([(1, 2)], "k int, r_k int")
    right = spark.createDataFrame([(1, 3, 4)], "k int, `a``b` int, r_r_k int")
    out = join(left, right, on=["l.k = r.k"])
    assert out.columns == ["k", "r_k", "r_r_r_k", "a`b", "r_r_k"]
    assert rows(out) == [(1, 2, 1, 3, 4)]


def test_ranges_of_many_pairs_are_joined_by_many_tasks(spark, monkeypatch):
    """Few bytes that make many pairs, in cells that are not full by their rows."""
    monkeypatch.setattr(range_joins, "CELL_PAIRS", 500)
    monkeypatch.setattr(range_joins, "TASK_PAIRS", 5_000)
    left = spark.sql("SELECT id AS a, CAST(id % 50 AS DOUBLE) AS x FROM range(1000)")
    right = spark.sql("SELECT id AS b, CAST(id % 50 AS DOUBLE) AS y FROM range(200)")
    step = {"operation": "join", "on": ["l.x BETWEEN r.y - 10 AND r.y + 10"], "with": "r"}
    for one, other in ((left, right), (right.toDF("a", "x"), left.toDF("b", "y"))):
        out = apply_steps(one, [step], inputs={"r": other})
        got = out.select("a", "b", F.spark_partition_id().alias("task")).collect()
        pairs = [(r.a, r.b) for r in got]
        rows = [(r.a, r.x) for r in one.collect()], [(r.b, r.y) for r in other.collect()]
        want = [(a, b) for a, x in rows[0] for b, y in rows[1] if y - 10 <= x <= y + 10]
        assert sorted(pairs) == sorted(want)
        tasks = [sum(r.task == t for r in got) for t in {r.task for r in got}]
        assert len(tasks) > 8
        assert max(tasks) < len(pairs) / 4
