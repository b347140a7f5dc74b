"""Scans of XML files and landing folders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions import tech_of
from nestflow.operators import apply_steps
from nestflow.queries import fixtures
from nestflow.queries.fixtures import ORDER_SCHEMA, PREFIXES, landing
from nestflow.queries.registry import query, table
from nestflow.sinks.publish import Folder
from nestflow.sources import (
    CORRUPT,
    SOURCE_FILE,
    infer_schema,
    narrow_schema,
    scan_elements,
    scan_fragments,
    scan_landing,
    scan_named,
    scan_xml,
    split_corrupt,
)
from nestflow.streaming import take_new_files, taken_rows
from nestflow.workspace import new_folder

PLACED = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, r_name AS market,
           CASE o_orderstatus WHEN 'F' THEN '2G' WHEN 'O' THEN '4G' ELSE '5G' END AS tech,
           CAST(date_trunc('year', o_orderdate) AS DATE) AS export_day
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def narrow(*paths: str) -> T.StructType:
    return narrow_schema(T.StructType.fromDDL(ORDER_SCHEMA), paths)


def lines_of(df: DataFrame, *columns: str, fields=("l_linenumber", "l_quantity")) -> DataFrame:
    """One row per line, and one for an order without lines."""
    picked = {c: c for c in columns} | {f"item.{f}": f for f in fields}
    return apply_steps(
        df,
        [
            {
                "operation": "explode",
                "column": "lines.item",
                "alias": "item",
                "keep": True,
                "outer": True,
            },
            {"operation": "select", "columns": {"_id": "o_orderkey"} | picked},
        ],
    )


ORDER_LINES = """
    SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
           l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
"""


def _order_lines(orders: DataFrame) -> DataFrame:
    orders = orders.withColumn("order_day", F.col("o_orderdate").cast("date").cast("string"))
    return lines_of(orders, "o_totalprice", "order_day")


ORDER_LINE_FIELDS = (
    "_id",
    "o_totalprice",
    "o_orderdate",
    "lines.item.l_linenumber",
    "lines.item.l_quantity",
)


@query(ORDER_LINES)
def scan_xml_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element with the row tag is a row."""
    path = fixtures.orders_xml(spark, sf_dir)
    return _order_lines(scan_xml(spark, path, "ord", narrow(*ORDER_LINE_FIELDS)))


@query(ORDER_LINES)
def scan_xml_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with many tasks per file."""
    path = fixtures.orders_large_xml(spark, sf_dir)
    return _order_lines(scan_fragments(spark, path, "ord", narrow(*ORDER_LINE_FIELDS)))


@query("""
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def scan_xml_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row tag that is nested in itself and stands in comments, CDATA and instructions."""
    path = fixtures.nested_tag_xml(spark, sf_dir)
    schema = "_id bigint, st string, ord array<struct<_id int, q double>>"
    orders = scan_elements(spark, path, "ord", schema)
    line = {"operation": "explode", "column": "ord", "alias": "line", "keep": True, "outer": True}
    columns = {
        "_id": "o_orderkey", "st": "o_orderstatus", "line._id": "l_linenumber",
        "line.q": "l_quantity",
    }
    return apply_steps(orders, [line, {"operation": "select", "columns": columns}])


@query("SELECT o_orderkey, o_totalprice FROM orders")
def scan_xml_any_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row tag by its local name, in splits, where files have different prefixes."""
    path = fixtures.prefixed_xml(spark, sf_dir)
    orders, _ = scan_named(spark, path, "ord", "_id bigint, p double", recursive=True)
    return orders.select(F.col("_id").alias("o_orderkey"), F.col("p").alias("o_totalprice"))


@query("""
    SELECT r_name AS "SubNetworkId", n_name AS "MeContextId",
           CAST(c_custkey AS VARCHAR) AS "ManagedElementId",
           CAST(o_orderkey AS VARCHAR) AS "MiddleVsDataContainerId",
           CAST(l_linenumber AS VARCHAR) AS "ChildVsDataContainerId"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def scan_xml_namespaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row tag without its prefix, ids of all levels."""
    schema = """
        SubNetwork array<struct<_id string, MeContext array<struct<_id string,
            ManagedElement array<struct<_id string, VsDataContainer array<struct<
                VsDataContainer array<struct<_id string,
                    VsDataContainer array<struct<_id string>>>>>>>>>>>>
    """
    exports = scan_xml(
        spark,
        fixtures.inventory_xml(spark, sf_dir),
        "configData",
        schema,
        ignore_namespace=True,
    )
    levels = {
        "net": "SubNetwork",
        "me": "net.MeContext",
        "element": "me.ManagedElement",
        "parent": "element.VsDataContainer",
        "middle": "parent.VsDataContainer",
        "child": "middle.VsDataContainer",
    }
    return apply_steps(
        exports,
        [
            *[
                {"operation": "explode", "column": column, "alias": alias, "keep": True}
                for alias, column in levels.items()
            ],
            {
                "operation": "select",
                "columns": {
                    "net._id": "SubNetworkId",
                    "me._id": "MeContextId",
                    "element._id": "ManagedElementId",
                    "middle._id": "MiddleVsDataContainerId",
                    "child._id": "ChildVsDataContainerId",
                },
            },
        ],
    )


@query("""
    SELECT o_orderkey, o_orderpriority, l_linenumber, l_quantity, l_returnflag
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def scan_xml_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the schema is inferred over all files, in splits, then cut to what is used."""
    path = fixtures.orders_large_xml(spark, sf_dir)
    fields = ("l_linenumber", "l_quantity", "l_returnflag")
    used = ["_id", "o_orderpriority", *[f"lines.item.{f}" for f in fields]]
    schema = narrow_schema(infer_schema(spark, path, "ord"), used)
    orders = scan_fragments(spark, path, "ord", schema)
    lines = lines_of(orders, "o_orderpriority", fields=fields)
    return lines.withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


def _landed(spark, sf_dir, *columns, more_markets=(), techs=("2G", "4G", "5G"), window=None):
    start, end = window or fixtures.export_days(spark, sf_dir)
    markets = [*fixtures.markets(spark, sf_dir), *more_markets]
    tree = landing(fixtures.landing_tree(spark, sf_dir))
    schema = narrow("_id", "lines.item.l_linenumber", "lines.item.l_quantity")
    rows = scan_landing(spark, tree, markets, list(techs), start, end, "ord", schema)
    rows = rows.withColumn("export_day", F.concat_ws("-", "year", "month", "day"))
    return lines_of(rows, *columns)


@query(f"""
    SELECT o_orderkey, tech, CAST(export_day AS VARCHAR) AS export_day, l_linenumber, l_quantity
    FROM ({PLACED}) LEFT JOIN lineitem ON o_orderkey = l_orderkey
    WHERE export_day BETWEEN DATE '1996-01-01' AND DATE '1998-01-01'
""")
def scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of days, both ends included."""
    window = (date(1996, 1, 1), date(1998, 1, 1))
    return _landed(spark, sf_dir, "tech", "export_day", window=window)


@query(f"""
    SELECT o_orderkey, tech, l_linenumber, l_quantity
    FROM ({PLACED}) LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE tech IN ('2G', '4G')
""")
def scan_tech_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only asked technologies; an unknown one is skipped."""
    return _landed(spark, sf_dir, "tech", techs=("4G", "9G", "2G"))


@query(f"""
    SELECT o_orderkey, market, l_linenumber, l_quantity
    FROM ({PLACED}) LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def scan_market_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buckets of all markets in one read; one of them does not exist."""
    return _landed(spark, sf_dir, "market", more_markets=["ATLANTIS"])


@query("""
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def scan_prefix_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files below a prefix, however deep."""
    path = fixtures.landing_tree(spark, sf_dir)
    schema = narrow(
        "_id", "o_orderstatus", "lines.item.l_linenumber", "lines.item.l_quantity"
    )
    rows = scan_xml(spark, path, "ord", schema, recursive=True, name_glob="*.xml.gz")
    return lines_of(rows, "o_orderstatus")


@query(f"""
    SELECT o_orderkey, CASE WHEN tech <> '5G' THEN tech END AS tech, l_linenumber, l_quantity
    FROM ({PLACED}) LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def route_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The technology by the first prefix in the path, null when there is none."""
    path = fixtures.landing_tree(spark, sf_dir)
    schema = narrow("_id", "lines.item.l_linenumber", "lines.item.l_quantity")
    rows = scan_xml(spark, path, "ord", schema, recursive=True, with_file=True)
    known = {tech: prefix for tech, prefix in PREFIXES.items() if tech != "5G"}
    return lines_of(rows.withColumn("tech", tech_of(F.col(SOURCE_FILE), known)), "tech")


@query("""
    SELECT o_orderkey, o_orderstatus, CAST(1 AS BIGINT) AS times_taken, FALSE AS cut_off FROM orders
    UNION ALL SELECT -min(o_orderkey), 'new', 1, FALSE FROM orders
    UNION ALL SELECT -max(o_orderkey), 'whole', 1, FALSE FROM orders
    UNION ALL SELECT NULL, NULL, 1, TRUE FROM orders HAVING count(*) > 0
""")
def scan_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs with a ledger. Files land before the first and the second, where one of
    the first is rewritten and one that its end cuts off comes; none land before the third."""
    schema = "_id bigint, o_orderstatus string"
    root = new_folder(spark, "incremental")
    where, out = f"{root}/in", f"{root}/out"
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"), "o_orderstatus"
    )
    low, high = orders.agg(F.min("_id"), F.max("_id")).first()
    finished = F.col("o_orderstatus") == "F"

    def record(number: int, status: str) -> str:
        return f'<ord id="{-number}"><o_orderstatus>{status}</o_orderstatus>'

    for run, arriving in enumerate((orders.filter(finished), orders.filter(~finished), None)):
        if arriving is not None:
            arriving.write.format("xml").option("rowTag", "ord").mode("append").save(where)
            if low is not None:
                landed = Folder(spark, where)
                landed.delete("again.xml")
                status = "new" if run else "earlier"
                landed.write("again.xml", f"<all>{record(low, status)}</ord></all>")
                if run:
                    whole = record(high, "whole")
                    landed.write("cut.xml", f"<all>{whole}</ord>{record(high, 'cut')}")
        take_new_files(spark, landing(where), where, "ord", schema, out)
    taken = taken_rows(spark, out)
    return taken.groupBy(
        F.col("_id").alias("o_orderkey"),
        "o_orderstatus",
        F.col(CORRUPT).isNotNull().alias("cut_off"),
    ).agg(F.count(F.lit(1)).alias("times_taken"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END
           AS o_totalprice, o_orderstatus = 'P' AS quarantined FROM orders
    UNION ALL
    SELECT -min(o_orderkey), 1.5, FALSE FROM orders GROUP BY o_orderpriority
    UNION ALL
    SELECT CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), TRUE FROM orders GROUP BY o_orderpriority
""")
def read_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that do not fit the schema, or that a file's end cuts off, go apart with
    their text; closing tags may hold white space."""
    schema = "_id bigint, o_orderstatus string, o_totalprice double"
    records = [
        scan_elements(spark, path, "ord", schema, keep_corrupt=True, recursive=True)
        for path in (fixtures.dirty_xml(spark, sf_dir), fixtures.cut_off_xml(spark, sf_dir))
    ]
    good, bad = split_corrupt(records[0].unionAll(records[1]))
    key, price = F.col("_id").alias("o_orderkey"), F.col("o_totalprice")
    cut_off = F.col(CORRUPT).startswith("<ord><o_orderstatus>F</o_orderstatus>")
    return good.select(key, price, F.lit(False).alias("quarantined")).union(
        bad.select(key, price, F.col(CORRUPT).contains("n/a") | cut_off)
    )


@query(f"""
    SELECT o_orderkey, tech, l_linenumber, l_quantity
    FROM ({PLACED}) LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def scan_empty_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A technology without files gives no rows, with the declared columns."""
    empty = _landed(spark, sf_dir, "tech", techs=("3G",))
    return empty.union(_landed(spark, sf_dir, "tech", techs=tuple(PREFIXES)))
