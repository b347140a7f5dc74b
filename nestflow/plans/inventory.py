"""Software inventory: one row per child container of a network element."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.paths import quote_path
from nestflow.operators import apply_steps
from nestflow.sources.tree import LEVEL, PATH, scan_tree

# --- Fixed values: element names of the inventory format and the names of the result. ---

ADMINISTRATIVE_DATA = [
    "es:type",
    "es:description",
    "es:productName",
    "es:productNumber",
    "es:productRevision",
    "es:productionDate",
]

ATTRIBUTES = "xn:attributes"
SW_ITEM = f"child.{ATTRIBUTES}.es:vsDataSwItem"

INVENTORY_COLUMNS = {
    "SubNetworkId": "SubNetworkId",
    "MeContext._id": "MeContextId",
    "element._id": "ManagedElementId",
    "parent._id": "ParentVsDataContainerId",
    f"parent.{ATTRIBUTES}.es:vsDataSystemFunctions": "ParentvsDataSystemFunctions",
    f"parent.{ATTRIBUTES}.xn:vsDataFormatVersion": "ParentvsDataFormatVersion",
    f"parent.{ATTRIBUTES}.xn:vsDataType": "ParentvsDataType",
    "middle._id": "MiddleVsDataContainerId",
    f"middle.{ATTRIBUTES}.es:vsDataSwInventory": "MiddlevsDataSwInventory",
    f"middle.{ATTRIBUTES}.xn:vsDataFormatVersion": "MiddlevsDataFormatVersion",
    f"middle.{ATTRIBUTES}.xn:vsDataType": "MiddlevsDataType",
    "child._id": "ChildVsDataContainerId",
    f"child.{ATTRIBUTES}.xn:vsDataType": "ChildVsDataType",
    f"child.{ATTRIBUTES}.xn:vsDataFormatVersion": "ChildVsDataFormatVersion",
    f"{SW_ITEM}.es:additionalInfo": "vsDataSwItemAdditionalInfo",
    f"{SW_ITEM}.es:administrativeData.es:type": "vsDataSwItemType",
    f"{SW_ITEM}.es:administrativeData.es:description": "vsDataSwItemDescription",
    f"{SW_ITEM}.es:administrativeData.es:productName": "vsDataSwItemProductName",
    f"{SW_ITEM}.es:administrativeData.es:productNumber": "vsDataSwItemProductNumber",
    f"{SW_ITEM}.es:administrativeData.es:productRevision": "vsDataSwItemProductRevision",
    f"{SW_ITEM}.es:administrativeData.es:productionDate": "vsDataSwItemProductDate",
    f"{SW_ITEM}.es:consistsOf": "vsDataSwItemConsistsOf",
    f"{SW_ITEM}.es:swItemId": "vsDataSwItemSwItemId",
    f"{SW_ITEM}.es:userLabel": "vsDataSwItemUserLabel",
}

# --- End of fixed values. ---


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def struct_field(name: str, *fields: T.StructField, array: bool = False) -> T.StructField:
    struct = T.StructType(list(fields))
    return T.StructField(name, T.ArrayType(struct) if array else struct)


SW_ITEM_FIELD = struct_field(
    "es:vsDataSwItem",
    *strings("es:swItemId", "es:additionalInfo"),
    struct_field("es:administrativeData", *strings(*ADMINISTRATIVE_DATA)),
)


CONTAINER = "xn:VsDataContainer"
#: Levels of containers that the 24 columns are of.
LEVELS = ("parent", "middle", "child")


def container(*attributes: T.StructField, below: T.StructField | None = None) -> T.StructField:
    """Containers: their ids, attributes and, if any, the containers below."""
    return struct_field(
        CONTAINER,
        *strings("_id"),
        struct_field(
            ATTRIBUTES, *attributes, *strings("xn:vsDataFormatVersion", "xn:vsDataType")
        ),
        *([below] if below else []),
        array=True,
    )


def me_context_schema(
    inventory: T.StructField | None = None,
    child: tuple[T.StructField, ...] = (SW_ITEM_FIELD,),
    depth: int = len(LEVELS),
) -> T.StructType:
    """One network element; ``inventory`` is the type of the middle container's inventory.

    Whatever may be repeated is an array: Spark's reader keeps only the last of repeated
    elements that are declared as one. ``depth`` is how many levels of containers are read,
    three at least; of those below, which Spark has no recursive type for, the ids are read
    one level deep, so that ``deeper_containers`` can tell of them.
    """
    if depth < len(LEVELS):
        raise ValueError(f"the inventory has {len(LEVELS)} levels of containers, not {depth}")
    below = struct_field(CONTAINER, *strings("_id"), array=True)
    for _ in range(depth - 2):
        below = container(*child, below=below)
    middle = inventory or struct_field("es:vsDataSwInventory", SW_ITEM_FIELD)
    parents = container(
        *strings("es:vsDataSystemFunctions"), below=container(middle, below=below)
    )
    element = struct_field("xn:ManagedElement", *strings("_id"), parents, array=True)
    return T.StructType([*strings("_id"), element])


def sub_network_schema(**options) -> T.StructType:
    """A sub-network and its network elements."""
    elements = T.StructField("xn:MeContext", T.ArrayType(me_context_schema(**options)))
    return T.StructType([*strings("_id"), elements])


def inventory_schema(**options) -> T.StructType:
    """One export: sub-networks and their network elements."""
    networks = T.ArrayType(sub_network_schema(**options))
    return T.StructType([T.StructField("xn:SubNetwork", networks)])


def _explode(column: str, alias: str) -> dict:
    return {"operation": "explode", "column": column, "alias": alias, "keep": True}


def _containers(depth: int) -> list[dict]:
    """Down to the containers of level ``depth``; those of level three and on are children."""
    above = ["element", *LEVELS[:2], *(["child"] * (depth - 2))]
    return [
        _explode(f"{a}.{CONTAINER}", b) for a, b in zip(above[:-1], above[1:], strict=True)
    ]


# From a row per network element, ``MeContext``: down the levels of containers.
CONTAINER_STEPS = [
    _explode("MeContext.xn:ManagedElement", "element"),
    *_containers(len(LEVELS)),
    {"operation": "select", "columns": INVENTORY_COLUMNS, "missing": "null"},
]

_CONTEXTS = [
    _explode("xn:SubNetwork", "network"),
    {
        "operation": "select",
        "columns": {"network._id": "SubNetworkId", "network.xn:MeContext": "MeContext"},
    },
    _explode("MeContext", "MeContext"),
]

# From a row per export.
INVENTORY_STEPS = [*_CONTEXTS, *CONTAINER_STEPS]


def container_tree(
    spark: SparkSession, paths: str | list[str], ancestors: Mapping[str, tuple[str, str]], **options
) -> DataFrame:
    """All containers, however deep, a row each: ``id``, its parent's id as ``parent``, ``level``
    from 1, ``path`` (the ids from the outermost container, with slashes), ``kind`` (its data
    type) and values of what is around the outermost one.

    A container without id counts as one of the id "". ``options`` are those of ``scan_tree``.
    """
    schema = T.StructType(
        [*strings("_id"), struct_field(ATTRIBUTES, *strings("xn:vsDataType"))]
    )
    rows = scan_tree(spark, paths, CONTAINER, schema, ancestors=ancestors, **options)
    kind = F.col(f"{quote_path([ATTRIBUTES])}.{quote_path(['xn:vsDataType'])}")
    return rows.select(
        *[quote_path([c]) for c in ancestors],
        LEVEL,
        F.element_at(PATH, -1).alias("id"),
        F.get(PATH, F.col(LEVEL) - 2).alias("parent"),
        F.array_join(PATH, "/").alias("path"),
        kind.alias("kind"),
    )


def deeper_containers(exports: DataFrame, depth: int = len(LEVELS)) -> DataFrame:
    """Containers below the levels that were read, which no row of the inventory shows.

    ``exports`` were read with the same ``depth``. A row per container of the last level that
    has some: its ids, and their number as ``deeper``. Read with more depth to see them.
    """
    steps = [*_CONTEXTS, _explode("MeContext.xn:ManagedElement", "element"), *_containers(depth)]
    ids = {
        "SubNetworkId": "SubNetworkId",
        "MeContext._id": "MeContextId",
        "element._id": "ManagedElementId",
        "child._id": "ChildVsDataContainerId",
        f"child.{CONTAINER}": "below",
    }
    rows = apply_steps(exports, [*steps, {"operation": "select", "columns": ids}])
    deeper = F.coalesce(F.array_size("below"), F.lit(0))
    return rows.withColumn("deeper", deeper).drop("below").filter("deeper > 0")
