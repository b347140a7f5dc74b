"""XML and nested tables that the queries read, written by Spark from the given tables.

Each is written once per session and table folder, to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.plans.inventory import ADMINISTRATIVE_DATA, CONTAINER, inventory_schema, strings
from nestflow.queries.registry import table
from nestflow.sinks.publish import Folder
from nestflow.sources import Landing
from nestflow.workspace import new_folder

# No record nests more lines than this; what has more is split over several records.
LINES_PER_RECORD = 1_000

# Rows that a task nests: more of them take more tasks than the session's.
ROWS_PER_TASK = 1_000_000

# Of records for the scans in splits, one in so many stands in plain files, which Spark cuts; the
# others' files are compressed, as plain text takes some twenty times the disk.
PLAIN_ONE_IN = 16

# A compressed file is read by one task, so the writers below cap its records.

LINE = (
    "struct<l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp_ntz>"
)
ORDER_SCHEMA = (
    "_id bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    f"o_orderdate timestamp_ntz, o_orderpriority string, lines struct<item: array<{LINE}>>"
)

# No files land for 3G.
PREFIXES = {"2G": "im=2G-f", "3G": "im=3G-x", "4G": "im=4G-o/", "5G": "im=5G-p"}

_written: dict[tuple[str, str, str], str] = {}


def _once(write: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """Turn a function that writes a fixture into one that returns its folder."""

    @wraps(write)
    def folder(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, write.__name__)
        if key not in _written:
            path = new_folder(spark, write.__name__)
            with _shuffles_dropped(spark):
                write(spark, sf_dir, path)
            _written[key] = path
        return _written[key]

    return folder


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The disk of what a job has shuffled is free when the job ends, not when the driver's memory
    is next cleaned up: the writes here run once, so nothing reads it again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The position in the scan is the same each time a task is run.
    return table(spark, sf_dir, "lineitem").withColumn(
        "position", F.monotonically_increasing_id()
    )


def _large_keys(counts: DataFrame, key: str) -> DataFrame:
    """Keys with more lines than a record may nest, and the number of records they need.

    ``counts`` has the lines by key. The table is written, so that Spark knows that it is small
    and does not shuffle all lines to join it.
    """
    spark = counts.sparkSession
    folder = new_folder(spark, "large_keys")
    large = counts.filter(F.col("lines") > LINES_PER_RECORD)
    pieces = F.ceil(F.col("lines") / LINES_PER_RECORD).alias("pieces")
    large.select(key, pieces).write.parquet(folder)
    return spark.read.parquet(folder)


def _together(lines: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """The lines of a key in one task, in as many tasks as so many rows need."""
    tasks = -(-rows // ROWS_PER_TASK)
    if tasks > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return lines.repartition(tasks, *keys)
    return lines.repartition(*keys)


def _with_piece(lines: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """The record, numbered within its key, that a line goes to.

    Repartition by key and piece before grouping by them: rows that are partitioned by
    key alone, as after this join, would be grouped where they are.
    """
    # Hashed, as the rows of a key may stand at every third place, say.
    piece = F.pmod(F.xxhash64("position"), F.coalesce("pieces", F.lit(1)))
    return lines.join(large, key, "left").withColumn("piece", piece).drop("pieces", "position")


def _for_each_piece(owners: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """An owner of lines once per record, so that it meets each record where that is.

    A join on the key alone would bring all records of a large key to one task.
    """
    last = F.coalesce("pieces", F.lit(1)) - 1
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    return owners.join(large, key, "left").withColumn("piece", pieces)


@_once
def orders_nested(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders with an array of their lines, as Parquet."""
    _nested(spark, sf_dir, table(spark, sf_dir, "orders")).write.parquet(path)


def _nested(spark: SparkSession, sf_dir: str, orders: DataFrame, *more: str) -> DataFrame:
    """These orders, with more columns of theirs, and an array of their lines."""
    item = F.struct(
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_returnflag",
        "l_shipdate",
    )
    lines = _numbered_lines(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    counts = lines.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    large = _large_keys(counts, "o_orderkey")
    lines = _with_piece(lines, large, "o_orderkey")
    lines = _together(lines, lines.count(), "o_orderkey", "piece")
    records = lines.groupBy("o_orderkey", "piece").agg(F.collect_list(item).alias("item"))
    orders = _for_each_piece(orders, large, "o_orderkey")
    nested = orders.join(records, ["o_orderkey", "piece"], "left")
    # An order without lines stays; a record of a large order that got no lines does not.
    nested = nested.filter(F.col("item").isNotNull() | F.col("pieces").isNull())
    return nested.select(
        F.col("o_orderkey").alias("_id"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
        F.struct("item").alias("lines"),
        *more,
    )


@_once
def orders_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The same as XML, one ``ord`` element per order."""
    orders = spark.read.parquet(orders_nested(spark, sf_dir))
    write_xml(orders, path, "ord", records_per_file=10_000)


@_once
def orders_large_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The same, some of it in plain files of any size, which a split scan reads in several
    tasks."""
    orders = spark.read.parquet(orders_nested(spark, sf_dir))
    _write_mixed(orders, F.xxhash64("_id"), path, "ord", records_per_file=10_000)


@_once
def dirty_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders without lines; pending ones have a price that is no number."""
    price = F.col("o_totalprice").cast("string")
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(price)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("_id"), "o_orderstatus", price.alias("o_totalprice")
    )
    write_xml(orders, path, "ord")


@_once
def cut_off_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A file per priority with a whole record, whose closing tag holds white space, and one
    that the file's end cuts off behind a child element."""
    first = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderkey"))
    text = F.concat(
        F.lit('<all><ord id="-'),
        F.col("min(o_orderkey)"),
        F.lit('"><o_totalprice>1.5</o_totalprice></ord\t><ord><o_orderstatus>F</o_orderstatus>'),
    )
    first = first.select(text.alias("value"), "o_orderpriority").repartition("o_orderpriority")
    first.write.partitionBy("o_orderpriority").text(path)


@_once
def nested_tag_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders and their lines in one tag, which also stands in comments, CDATA and
    instructions; half of the closing tags hold white space."""

    def line(item: Column) -> Column:
        return F.concat(
            F.lit('<ord id="'), item["l_linenumber"].cast("string"),
            F.lit('"><q>'), item["l_quantity"].cast("string"), F.lit("</q></ord>"),
        )

    orders = spark.read.parquet(orders_nested(spark, sf_dir))
    lines = F.array_join(F.transform(F.coalesce("lines.item", F.array()), line), "")
    end = F.when(F.col("_id") % 2 == 0, "</ord >").otherwise("</ord>")
    text = F.concat(
        F.lit('<!-- an <ord> --><ord id="'), F.col("_id").cast("string"),
        F.lit('"><!-- no </ord> --><st>'), "o_orderstatus", F.lit("</st>"), lines,
        F.lit('<t><![CDATA[</ord><ord id="0">]]></t><?end </ord> ?>'), end,
    )
    orders.select(text.alias("value")).write.text(path)


@_once
def deep_inventory_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Customers as network elements with containers down to eight levels: on each level one
    without others below, and, but on the last, one that holds the next level."""

    def container(number: Column, kind: str) -> Column:
        return F.concat(
            F.lit(f'<{CONTAINER} id="'), (F.col("c_custkey") * 100 + number).cast("string"),
            F.lit(f'"><xn:attributes><xn:vsDataType>{kind}</xn:vsDataType></xn:attributes>'),
        )

    def level(k: Column) -> Column:
        leaf = F.concat(container(50 + k, "leaf"), F.lit(f"</{CONTAINER}>"))
        return F.concat(container(k, "branch"), leaf)

    depth = (1 + F.col("c_custkey") % 8).cast("int")
    text = F.concat(
        F.lit('<xn:MeContext id="'), "c_mktsegment", F.lit('"><xn:ManagedElement id="'),
        F.col("c_custkey").cast("string"), F.lit('">'),
        F.array_join(F.transform(F.sequence(F.lit(1), depth), level), ""),
        F.repeat(F.lit(f"</{CONTAINER}>"), depth), F.lit("</xn:ManagedElement></xn:MeContext>"),
    )
    table(spark, sf_dir, "customer").select(text.alias("value")).write.text(path)


@_once
def prefixed_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders under one prefix if they are finished, else under another, in files apart."""
    finished = F.col("o_orderstatus") == "F"
    tag = F.when(finished, "fin:ord").otherwise("open:ord")
    text = F.concat(
        F.lit("<"), tag, F.lit(' id="'), F.col("o_orderkey").cast("string"), F.lit('"><x:p>'),
        F.col("o_totalprice").cast("string"), F.lit("</x:p><x:ords/></"), tag, F.lit(">"),
    )
    orders = table(spark, sf_dir, "orders").select(text.alias("value"), finished.alias("finished"))
    orders.write.partitionBy("finished").text(path)


@_once
def broken_line_tree(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``line_tree`` with a file in each market that is no archive, though its name says so."""
    line_tree.__wrapped__(spark, sf_dir, path)
    tree = Folder(spark, path)
    for market in tree.names("market=*"):
        for day in tree.names(f"{market}/im=2G-f/*/*/*")[:1]:
            tree.write(f"{day}/broken.xml.gz", "<all><ln id='1'></ln></all>")


def markets(spark: SparkSession, sf_dir: str) -> list[str]:
    """All regions, each a market."""
    names = table(spark, sf_dir, "region").select("r_name").distinct().orderBy("r_name")
    return [row["r_name"] for row in names.collect()]


def export_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The first and the last day of which there are exports."""
    days = table(spark, sf_dir, "orders").select(export_day().alias("day"))
    first, last = days.agg(F.min("day"), F.max("day")).first()
    return first or date(1970, 1, 1), last or date(1970, 1, 1)


def export_day():
    """Exports are made on the first day of a year."""
    return F.trunc(F.col("o_orderdate").cast("date"), "year")


def landed_orders(spark: SparkSession, orders: DataFrame, sf_dir: str) -> DataFrame:
    """Orders with the folder they land in: market, technology folder and day."""
    folder = (
        F.when(F.col("o_orderstatus") == "F", "2G-f")
        .when(F.col("o_orderstatus") == "O", "4G-o")
        .otherwise("5G-p")
    )
    return (
        orders.join(customer_places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("market", F.col("r_name"))
        .withColumn("im", folder)
        .withColumn("year", F.date_format(export_day(), "yyyy"))
        .withColumn("month", F.date_format(export_day(), "MM"))
        .withColumn("day", F.date_format(export_day(), "dd"))
        .drop("c_custkey", "n_name", "r_name")
    )


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name", "r_name"
    )


@_once
def landing_tree(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders in day folders per market and technology; urgent pending ones lack a price."""
    orders = table(spark, sf_dir, "orders")
    bad = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.when(bad, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    folders = ["market", "im", "year", "month", "day"]
    # Orders find their folders before they nest lines, which are then shuffled once less.
    landed = landed_orders(spark, orders.withColumn("o_totalprice", price), sf_dir)
    landed = _nested(spark, sf_dir, landed, *folders)
    landed = landed.hint("rebalance", *folders)
    write_xml(landed, path, "ord", folders=folders, records_per_file=50_000)


@_once
def line_tree(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A record per line in the same folders; those of urgent pending orders lack a price."""
    orders = landed_orders(spark, table(spark, sf_dir, "orders"), sf_dir)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    bad = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.when(bad, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    folders = ["market", "im", "year", "month", "day"]
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("_id"), "l_quantity", price.alias("price"), *folders
    )
    rows = rows.hint("rebalance", *folders)
    write_xml(rows, path, "ln", folders=folders, records_per_file=500_000)


def landing(root: str) -> Landing:
    return Landing(f"{root}/market={{}}", PREFIXES)


INVENTORY_TYPE = {"inventory": strings("es:vsDataSwInventory")[0]}


def read_schema():
    """Schema of ``inventory_xml``: the middle container's inventory is a text."""
    return inventory_schema(**INVENTORY_TYPE)


# Customers of an export, and of a context within it.
EXPORT_CUSTOMERS = 16
CONTEXT_CUSTOMERS = 4


@_once
def inventory_nested(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Exports of some customers, each a network element: several sub-networks (regions) in an
    export, contexts (nations) in a sub-network, elements (customers) in a context, parents
    (order states) in an element, orders in a parent and lines in an order.
    """
    _exports(spark, sf_dir).write.option("compression", "zstd").parquet(path)


def _exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customer = customer.join(customer_places(spark, sf_dir), "c_custkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"
    )
    lines = _numbered_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus",
        "l_returnflag", F.col("l_shipdate").cast("date").alias("l_shipdate"), "position",
    )
    of_order = F.col("l_orderkey") == F.col("o_orderkey")
    counts = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    counts = counts.join(orders.select("o_orderkey", "o_custkey"), of_order)
    counts = counts.groupBy("o_custkey").agg(F.sum("lines").alias("lines"))
    large = _large_keys(counts, "o_custkey")
    rows = lines.count()
    # Lines take no more along than they need to get to their export: what is around them goes
    # there by itself, a row per order and piece. Each of them is text, a multiple of the lines.
    # An order that stands twice meets its lines there as often.
    keys = orders.select("o_orderkey", "o_custkey").filter("o_custkey IS NOT NULL").distinct()
    lines = _with_piece(lines.join(keys, of_order), large, "o_custkey").drop("l_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_brand", "p_size")
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    owners = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    owners = _for_each_piece(owners, large, "o_custkey").drop("pieces")
    of_line = ["o_custkey", "piece", "o_orderkey"]
    line = F.struct(*[c for c in lines.columns if c not in of_line])
    owner = F.struct(*[c for c in owners.columns if c not in of_line])
    both = lines.select(*of_line, line.alias("line")).unionByName(
        owners.select(*of_line, owner.alias("owner")), allowMissingColumns=True
    )
    export = F.floor(F.col("o_custkey") / EXPORT_CUSTOMERS)
    both = _together(both, rows, export, "piece").withColumn("export", export)
    both = both.groupBy("export", *of_line).agg(
        F.collect_list("line").alias("lines"), F.collect_list("owner").alias("owners")
    )
    both = both.filter(F.size("lines") > 0).withColumn("owner", F.explode("owners"))
    containers = both.select("export", *of_line, "lines", "owner.*").withColumn(
        "part", F.floor(F.col("o_custkey") / CONTEXT_CUSTOMERS)
    )
    above = ["export", "piece"]
    networks_of = [*above, "r_name"]
    contexts_of = [*networks_of, "part", "n_name"]
    elements_of = [*contexts_of, "o_custkey"]
    parents_of = [*elements_of, "c_name", "c_mktsegment", "o_orderstatus"]

    def child(line: Column) -> Column:
        administrative = [
            line[c] for c in ("p_type", "p_name", "p_brand", "l_partkey", "p_size", "l_shipdate")
        ]
        sw_item = F.struct(
            _text(line["l_partkey"], "es:swItemId"),
            _text(line["l_suppkey"], "es:additionalInfo"),
            F.struct(*map(_text, administrative, ADMINISTRATIVE_DATA)).alias(
                "es:administrativeData"
            ),
        )
        return F.struct(
            _text(line["l_linenumber"], "_id"),
            _attributes(
                sw_item.alias("es:vsDataSwItem"), line["l_linestatus"], line["l_returnflag"]
            ),
        )

    middle = F.struct(
        _text(F.col("o_orderkey"), "_id"),
        _attributes(
            _text(F.col("o_orderpriority"), "es:vsDataSwInventory"),
            F.lit("1.1"),
            F.col("o_orderstatus"),
        ),
        F.transform("lines", child).alias(CONTAINER),
    )
    parents = containers.groupBy(*parents_of).agg(F.collect_list(middle).alias(CONTAINER))
    parent = F.struct(
        _text(F.col("o_custkey"), "_id"),
        _attributes(
            _text(F.col("c_name"), "es:vsDataSystemFunctions"), F.lit("1.0"), F.col("c_mktsegment")
        ),
        F.col(CONTAINER),
    )
    elements = parents.groupBy(*elements_of).agg(F.collect_list(parent).alias(CONTAINER))
    element = F.struct(_text(F.col("o_custkey"), "_id"), F.col(CONTAINER))
    contexts = elements.groupBy(*contexts_of).agg(
        F.collect_list(element).alias("xn:ManagedElement")
    )
    context = F.struct(_text(F.col("n_name"), "_id"), F.col("xn:ManagedElement"))
    networks = contexts.groupBy(*networks_of).agg(F.collect_list(context).alias("xn:MeContext"))
    network = F.struct(_text(F.col("r_name"), "_id"), F.col("xn:MeContext"))
    return networks.groupBy(*above).agg(F.collect_list(network).alias("xn:SubNetwork"))


@_once
def inventory_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The exports as XML, one ``xn:configData`` element each."""
    exports = spark.read.parquet(inventory_nested(spark, sf_dir))
    write_xml(exports.select("xn:SubNetwork"), path, "xn:configData", records_per_file=200)


@_once
def inventory_large_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The same, some of it in plain files of any size, which a split scan reads in several
    tasks."""
    exports = spark.read.parquet(inventory_nested(spark, sf_dir))
    chosen = F.xxhash64("export", "piece")
    columns = ["xn:SubNetwork"]
    _write_mixed(exports, chosen, path, "xn:configData", columns, records_per_file=200)


def _text(column, name: str):
    return column.cast("string").alias(name)


def _attributes(first, version, kind):
    return F.struct(
        first, _text(version, "xn:vsDataFormatVersion"), _text(kind, "xn:vsDataType")
    ).alias("xn:attributes")


def _write_mixed(df, chosen, path, row_tag, columns=("*",), records_per_file=0) -> None:
    plain = F.pmod(chosen, F.lit(PLAIN_ONE_IN)) == 0
    write_xml(df.filter(plain).select(*columns), path, row_tag, compression="none")
    rest = df.filter(~plain).select(*columns)
    write_xml(rest, path, row_tag, records_per_file=records_per_file, mode="append")


def write_xml(
    df, path, row_tag, folders=(), records_per_file=0, mode="error", compression="gzip"
) -> None:
    writer = df.write.format("xml").option("rowTag", row_tag).option("rootTag", "exports")
    # Indents are more than half of deeply nested records.
    writer = writer.option("indent", "").option("compression", compression)
    # Names with a prefix hold a colon, which the check would refuse.
    writer = writer.option("validateName", False).option("maxRecordsPerFile", records_per_file)
    writer.mode(mode).partitionBy(*folders).save(path)
