"""Parquet output, read back."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.functions import output_name
from nestflow.operators import apply_steps
from nestflow.queries import fixtures
from nestflow.queries.fixtures import landing
from nestflow.queries.registry import query, table
from nestflow.queries.scans import PLACED, narrow
from nestflow.sinks import SAVE_MODES, write_parquet, write_partitioned
from nestflow.sources import SOURCE_FILE, scan_landing
from nestflow.workspace import new_folder


@query("""
    SELECT 'overwrite' AS mode, o_orderkey, 2 * o_totalprice AS price FROM orders
    UNION ALL SELECT 'append', o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT 'append', o_orderkey, 2 * o_totalprice FROM orders
    UNION ALL SELECT 'ignore', o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT 'errorifexists', o_orderkey, o_totalprice FROM orders
""")
def write_parquet_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: two writes in each mode, the second with doubled prices."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price")
    )
    root = new_folder(spark, "modes")
    results = []
    for mode in SAVE_MODES:
        path = f"{root}/{mode}"
        write_parquet(orders, path, mode)
        try:
            write_parquet(orders.withColumn("price", 2 * F.col("price")), path, mode)
        except AnalysisException as error:
            if mode != "errorifexists" or error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        results.append(spark.read.parquet(path).select(F.lit(mode).alias("mode"), "*"))
    return reduce(DataFrame.union, results)


@query(f"""
    SELECT market, tech, CAST(export_day AS VARCHAR) AS export_day, TRUE AS same_base,
           CAST(sum(n) AS BIGINT) AS lines
    FROM (
        SELECT market, tech, export_day, (SELECT count(*) FROM lineitem
               WHERE l_orderkey = o_orderkey) AS n
        FROM ({PLACED})
    ) GROUP BY market, tech, export_day
""")
def output_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the base name of the source with its suffix replaced."""
    tree = landing(fixtures.landing_tree(spark, sf_dir))
    schema = narrow("_id", "lines.item.l_linenumber")
    markets, days = fixtures.markets(spark, sf_dir), fixtures.export_days(spark, sf_dir)
    rows = scan_landing(spark, tree, markets, ["2G", "4G", "5G"], *days, "ord", schema)
    # Told without the operator: the file's name up to its suffix, and the new suffix.
    base = F.regexp_extract(SOURCE_FILE, r"([^/]*)\.xml\.gz$", 1)
    rows = rows.withColumn("output", output_name(F.col(SOURCE_FILE))).withColumn(
        "same", (F.length(base) > 0) & (F.col("output") == F.concat(base, F.lit(".parquet")))
    )
    return rows.groupBy(
        "market", "tech", F.concat_ws("-", "year", "month", "day").alias("export_day")
    ).agg(
        F.bool_and("same").alias("same_base"),
        F.sum(F.coalesce(F.array_size("lines.item"), F.lit(0))).alias("lines"),
    )


@query(f"""
    SELECT o_orderkey, market, tech, CAST(export_day AS VARCHAR) AS export_day,
           CASE market WHEN 'EUROPE' THEN 2 * o_totalprice ELSE o_totalprice END AS price
    FROM ({PLACED})
""")
def write_partitioned_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a second write replaces the partitions it has rows for, the others stay."""
    out = new_folder(spark, "by-partition")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_totalprice", "price")
    landed = fixtures.landed_orders(spark, orders, sf_dir).withColumn(
        "tech", F.substring("im", 1, 2)
    )
    landed = landed.select("o_orderkey", "price", "market", "tech", "year", "month", "day")
    write_partitioned(landed, out)
    europe = landed.filter(F.col("market") == "EUROPE")
    write_partitioned(europe.withColumn("price", 2 * F.col("price")), out)
    day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    return apply_steps(
        spark.read.parquet(out).withColumn("export_day", day.cast("string")),
        [
            {
                "operation": "select",
                "columns": {
                    c: c for c in ("o_orderkey", "market", "tech", "export_day", "price")
                },
            }
        ],
    )
