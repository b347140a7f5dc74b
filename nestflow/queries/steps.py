"""One query per flatten step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.operators import apply_steps
from nestflow.queries import fixtures
from nestflow.queries.registry import query, table
from nestflow.workspace import new_folder


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(fixtures.orders_nested(spark, sf_dir))


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


# --- select ---


@query("""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total FROM orders
""")
def step_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """project and rename."""
    columns = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "total"}
    return apply_steps(
        table(spark, sf_dir, "orders"), [{"operation": "select", "columns": columns}]
    )


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = F.struct(
        F.col("c_name").alias("es:userLabel"), F.col("c_mktsegment").alias("xn:vsDataType")
    )
    element = F.struct(F.col("c_custkey").alias("_id"), attributes.alias("xn:attributes"))
    return table(spark, sf_dir, "customer").select(element.alias("xn:ManagedElement"), "c_acctbal")


@query("SELECT c_custkey AS id, c_name AS label, c_mktsegment AS kind FROM customer")
def step_select_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths through structs, with prefixed names."""
    columns = {
        "xn:ManagedElement._id": "id",
        "xn:ManagedElement.xn:attributes.es:userLabel": "label",
        "xn:ManagedElement.xn:attributes.xn:vsDataType": "kind",
    }
    return apply_steps(
        _elements(spark, sf_dir), [{"operation": "select", "columns": columns}]
    )


@query("""
    SELECT o_orderkey, l_quantity AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def step_select_array_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of an array of structs is an array, here taken apart again."""
    columns = {"_id": "o_orderkey", "lines.item.l_quantity": "quantity"}
    return apply_steps(
        _nested(spark, sf_dir),
        [
            {"operation": "select", "columns": columns},
            {"operation": "explode", "column": "quantity", "alias": "quantity", "keep": True},
        ],
    )


@query("""
    SELECT o_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
           l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def step_select_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of a struct, then one row of fields per element of an array."""
    ship_day = "CAST(CAST(col('l_shipdate') AS DATE) AS STRING)"
    return apply_steps(
        _nested(spark, sf_dir),
        [
            {"operation": "select", "columns": {"_id": "o_orderkey", "lines.*": "lines"}},
            {"operation": "select", "columns": {"o_orderkey": "o_orderkey", "item.*": "item"}},
            {"operation": "withColumn", "column": "ship_day", "func": ship_day},
            {
                "operation": "select",
                "columns": _same(
                    "o_orderkey",
                    "l_linenumber",
                    "l_partkey",
                    "l_quantity",
                    "l_extendedprice",
                    "l_discount",
                    "l_returnflag",
                    "ship_day",
                ),
            },
        ],
    )


@query("SELECT c_custkey AS id, CAST(NULL AS VARCHAR) AS consists_of FROM customer")
def step_select_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1d: a path that is not there gives null."""
    columns = {
        "xn:ManagedElement._id": "id",
        "xn:ManagedElement.xn:attributes.es:consistsOf": "consists_of",
    }
    steps = [{"operation": "select", "columns": columns, "missing": "null"}]
    return apply_steps(_elements(spark, sf_dir), steps)


@query("""
    SELECT r_name AS sub_network, n_name AS me
    FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def step_select_dotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1e: a flat column whose name holds a dot."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    flat = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("xn:SubNetwork._id"),
        F.struct(F.col("n_name").alias("_id")).alias("xn:SubNetwork.xn:MeContext"),
    )
    columns = {"xn:SubNetwork._id": "sub_network", "xn:SubNetwork.xn:MeContext._id": "me"}
    return apply_steps(flat, [{"operation": "select", "columns": columns}])


# --- explode ---


@query("SELECT l_partkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def step_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per element, nothing else is left."""
    return apply_steps(
        _nested(spark, sf_dir),
        [
            {"operation": "explode", "column": "lines.item", "alias": "item"},
            {
                "operation": "select",
                "columns": {"item.l_partkey": "l_partkey", "item.l_quantity": "l_quantity"},
            },
        ],
    )


def _exploded(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    columns = {"_id": "o_orderkey", "o_custkey": "o_custkey", "item.l_partkey": "l_partkey"}
    explode = {"operation": "explode", "column": "lines.item", "alias": "item", "keep": True}
    return apply_steps(
        _nested(spark, sf_dir),
        [explode | options, {"operation": "select", "columns": columns}],
    )


@query("""
    SELECT o_orderkey, o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def step_explode_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns beside the array stay."""
    return _exploded(spark, sf_dir)


@query("""
    SELECT o_orderkey, o_custkey, l_partkey
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def step_explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without elements stays."""
    return _exploded(spark, sf_dir, outer=True)


@query("""
    SELECT o_orderkey, 'priority' AS info_key, o_orderpriority AS info_value FROM orders
    UNION ALL SELECT o_orderkey, 'status', o_orderstatus FROM orders
""")
def step_explode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map gives a key and a value column."""
    info = F.create_map(
        F.lit("priority"), F.col("o_orderpriority"), F.lit("status"), F.col("o_orderstatus")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", info.alias("info"))
    return apply_steps(
        orders,
        [
            {"operation": "explode", "column": "info", "alias": "info", "keep": True},
            {"operation": "select", "columns": _same("o_orderkey", "info_key", "info_value")},
        ],
    )


@query("""
    SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def step_explode_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a struct counts as an array of one, a null one as an empty array."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    once = F.when(urgent, F.struct(F.col("o_totalprice").alias("price")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", once.alias("item"))
    return apply_steps(
        orders,
        [
            {"operation": "explode", "column": "item", "alias": "item", "keep": True},
            {
                "operation": "select",
                "columns": {"o_orderkey": "o_orderkey", "item.price": "price"},
            },
        ],
    )


# --- filter ---


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity > 45 AND l_discount >= 0.05
""")
def step_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a SQL condition."""
    return apply_steps(
        table(spark, sf_dir, "lineitem"),
        [
            {"operation": "filter", "condition": "l_quantity > 45 AND l_discount >= 0.05"},
            {"operation": "select", "columns": _same("l_orderkey", "l_linenumber", "l_quantity")},
        ],
    )


# --- join ---


def _orders_and_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity"
    )
    return orders, lines


JOINED = ("o_orderkey", "o_totalprice", "l_linenumber", "l_quantity")


def _join(left: DataFrame, right: DataFrame, columns=JOINED, **options) -> DataFrame:
    return apply_steps(
        left,
        [
            {"operation": "join", "with": "other", "on": "o_orderkey"} | options,
            {"operation": "select", "columns": _same(*columns)},
        ],
        inputs={"other": right},
    )


def _joined_sql(kind: str) -> str:
    return f"""
        SELECT o_orderkey, o_totalprice, l_linenumber, l_quantity
        FROM orders {kind} JOIN lineitem ON o_orderkey = l_orderkey
    """


@query(_joined_sql("INNER"))
def step_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """inner join on a key name."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(lines, orders)


@query(_joined_sql("LEFT"))
def step_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a match stay."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(orders, lines, how="left_outer")


@query(_joined_sql("LEFT"))
def step_join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the other input without a match stay."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(lines, orders, how="right_outer")


@query(_joined_sql("FULL"))
def step_join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both without a match stay."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(lines, orders, how="full_outer")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def step_join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have a match."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(orders, lines, JOINED[:2], how="left_semi")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def step_join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have none."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(orders, lines, JOINED[:2], how="left_anti")


@query(_joined_sql("INNER"))
def step_join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross with a key, which pairs rows of equal keys only."""
    orders, lines = _orders_and_lines(spark, sf_dir)
    return _join(orders, lines, how="cross")


@query("""
    SELECT o_orderkey, o_totalprice, l_linenumber, l_extendedprice
    FROM orders LEFT JOIN lineitem
    ON o_orderkey = l_orderkey AND l_extendedprice > o_totalprice / 10
""")
def step_join_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An equality and an inequality between the sides."""
    return _join(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        ("o_orderkey", "o_totalprice", "l_linenumber", "l_extendedprice"),
        on="l.o_orderkey = r.l_orderkey AND r.l_extendedprice > l.o_totalprice / 10",
        how="left_outer",
    )


def _near_balances(spark, sf_dir, width: str, how: str) -> DataFrame:
    return _join(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "supplier"),
        ("c_custkey", "s_suppkey"),
        on=f"l.c_acctbal BETWEEN r.s_acctbal - {width} AND r.s_acctbal + {width}",
        how=how,
    )


@query("""
    SELECT c_custkey, s_suppkey FROM customer JOIN supplier
    ON c_acctbal BETWEEN s_acctbal - 25.0 AND s_acctbal + 25.0
""")
def step_join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No equality, but bounds in both directions."""
    return _near_balances(spark, sf_dir, "25.0", "inner")


@query("""
    SELECT c_custkey, s_suppkey FROM customer LEFT JOIN supplier
    ON c_acctbal BETWEEN s_acctbal - 2.0 AND s_acctbal + 2.0
""")
def step_join_range_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the customers that have no supplier near."""
    return _near_balances(spark, sf_dir, "2.0", "left_outer")


@query("""
    SELECT o_orderkey, o_totalprice, l_linenumber, l_extendedprice
    FROM orders JOIN lineitem
    ON o_orderkey = l_orderkey AND (l_linenumber = 1 OR l_extendedprice > o_totalprice / 2)
""")
def step_join_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An equality, and a condition with ``or`` in parentheses."""
    return _join(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        ("o_orderkey", "o_totalprice", "l_linenumber", "l_extendedprice"),
        on="l.o_orderkey = r.l_orderkey "
        "AND (r.l_linenumber = 1 OR r.l_extendedprice > l.o_totalprice / 2)",
        how="inner",
    )


# --- groupBy and agg ---


def _grouped(spark, sf_dir, columns, aggregations) -> DataFrame:
    return apply_steps(
        table(spark, sf_dir, "lineitem"),
        [
            {"operation": "groupBy", "columns": columns},
            {"operation": "agg", "aggregations": aggregations},
        ],
    )


@query("""
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_quantity,
           round(avg(l_extendedprice), 4) AS avg_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def step_group_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sum and avg per group."""
    return _grouped(
        spark,
        sf_dir,
        ["l_returnflag", "l_linestatus"],
        {"sum_quantity": "sum(l_quantity)", "avg_price": "round(avg(l_extendedprice), 4)"},
    )


@query("""
    SELECT l_partkey, count(*) AS lines, min(l_extendedprice) AS low,
           max(l_extendedprice) AS high, count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY l_partkey
""")
def step_group_agg_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count, min, max and count of distinct values."""
    return _grouped(
        spark,
        sf_dir,
        "l_partkey",
        {
            "lines": "count(*)",
            "low": "min(l_extendedprice)",
            "high": "max(l_extendedprice)",
            "suppliers": "count(DISTINCT l_suppkey)",
        },
    )


@query("""
    SELECT count(*) AS lines, sum(l_quantity) AS sum_quantity,
           max(l_extendedprice) AS high FROM lineitem
""")
def step_agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No groups, one row."""
    aggregations = {
        "lines": "count(*)",
        "sum_quantity": "sum(l_quantity)",
        "high": "max(l_extendedprice)",
    }
    return apply_steps(
        table(spark, sf_dir, "lineitem"), [{"operation": "agg", "aggregations": aggregations}]
    )


# --- orderBy, union, distinct, withColumn ---


@query("""
    SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders
    ORDER BY o_orderpriority ASC NULLS FIRST, o_totalprice DESC NULLS LAST
""")
def step_order_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: one column up, one down."""
    columns = _same("o_orderpriority", "o_totalprice", "o_orderkey")
    return apply_steps(
        table(spark, sf_dir, "orders"),
        [
            {"operation": "select", "columns": columns},
            {"operation": "orderBy", "columns": {"o_orderpriority": True, "o_totalprice": False}},
        ],
    )


@query("""
    SELECT o_orderpriority, count(*) AS orders, min(o_totalprice) AS least,
           CAST(row_number() OVER (ORDER BY o_orderpriority DESC NULLS LAST) AS INTEGER) AS band,
           TRUE AS apart
    FROM orders GROUP BY o_orderpriority
""")
def step_order_by_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: the places of the sorted rows. Each priority is a band of its own, in order, and
    within it no price is below the next one's: a band's least price is at its first place."""
    by = {"o_orderpriority": False, "o_totalprice": True}
    ordered = apply_steps(
        table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice"),
        [{"operation": "orderBy", "columns": by}],
    )
    placed = ordered.withColumn("place", F.monotonically_increasing_id())
    bands = placed.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min_by("o_totalprice", "place").alias("least"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
    )
    bands = _numbered(bands.orderBy("first"), "band")
    after = bands.select((F.col("band") - 1).alias("band"), F.col("first").alias("after"))
    return bands.join(after, "band", "left").select(
        "o_orderpriority",
        "orders",
        "least",
        F.col("band").cast("int").alias("band"),
        F.coalesce(F.col("last") < F.col("after"), F.lit(True)).alias("apart"),
    )


def _numbered(ordered: DataFrame, name: str) -> DataFrame:
    """The rows with their number from 1 in the order they have, without bringing them to one
    task: a task's rows follow on those of the tasks before it, of which only counts meet."""
    spark, path = ordered.sparkSession, new_folder(ordered.sparkSession, "numbered-rows")
    placed = ordered.withColumn("place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    placed = placed.withColumn("task", F.shiftright("place", 33))
    counts = placed.groupBy("task").agg(F.count(F.lit(1)).alias("rows"))
    tasks = counts.agg(F.array_sort(F.collect_list(F.struct("task", "rows"))).alias("tasks"))
    tasks = tasks.select("tasks", F.posexplode("tasks").alias("pos", "own"))
    earlier = F.slice("tasks", F.lit(1), F.col("pos"))
    before = F.aggregate(earlier, F.lit(0).cast("bigint"), lambda n, task: n + task["rows"])
    starts = tasks.select("own.task", before.alias("before"))
    row = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.join(starts, "task").withColumn(name, F.col("before") + row + 1)
    return numbered.drop("task", "before", "place")


@query("""
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
""")
def step_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """by position, copies stay."""
    columns = {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"}
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return apply_steps(
        table(spark, sf_dir, "customer"),
        [{"operation": "select", "columns": columns}, {"operation": "union"}],
        inputs={"supplier": supplier},
    )


@query("""
    SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier
""")
def step_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that differ."""
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return apply_steps(
        table(spark, sf_dir, "customer"),
        [
            {"operation": "select", "columns": {"c_custkey": "id", "c_mktsegment": "segment"}},
            {"operation": "union", "with": "supplier", "by_name": True},
        ],
        inputs={"supplier": supplier},
    )


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def step_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """copies go."""
    return apply_steps(
        table(spark, sf_dir, "lineitem"),
        [
            {"operation": "select", "columns": _same("l_orderkey", "l_linenumber")},
            {"operation": "distinct"},
        ],
    )


@query("SELECT p_partkey, p_name, 'checked' AS p_brand, CAST(7 AS INTEGER) AS batch FROM part")
def step_with_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """replace a column and add one; a value goes before an expression."""
    return apply_steps(
        table(spark, sf_dir, "part"),
        [
            {"operation": "select", "columns": _same("p_partkey", "p_name", "p_brand")},
            {"operation": "withColumn", "column": "p_brand", "value": "checked"},
            {"operation": "withColumn", "column": "batch", "value": 7, "func": "p_partkey"},
        ],
    )


@query("""
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue,
           l_quantity * 2 AS doubled
    FROM lineitem
""")
def step_with_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text, and the older spelling with col()."""
    revenue = "round(l_extendedprice * (1 - l_discount), 4)"
    return apply_steps(
        table(spark, sf_dir, "lineitem"),
        [
            {"operation": "withColumn", "column": "revenue", "func": revenue},
            {"operation": "withColumn", "column": "doubled", "func": "col('l_quantity') * 2"},
            {
                "operation": "select",
                "columns": _same("l_orderkey", "l_linenumber", "revenue", "doubled"),
            },
        ],
    )
