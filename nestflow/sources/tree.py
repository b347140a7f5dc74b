"""Elements that are nested in themselves to any depth, a row each.

Spark has no recursive type, so a schema reads as many levels as it spells out. Here each round
parses one level: the outermost elements are cut from the files, and from the text of each
level's elements those directly below, until a round finds none. Every round is a job over the
elements of its level, which are written, so that no round makes an earlier one's again and the
children of a large element are dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.paths import quote_path, top
from nestflow.sources.elements import TEXT, Cutter, scan_elements
from nestflow.sources.xml import text_attributes, typed
from nestflow.workspace import new_folder, ship_library

#: Columns that ``scan_tree`` adds.
NODE, PARENT, LEVEL, PATH = "node", "parent_node", "level", "id_path"


def children(text: str, row_tag: str) -> list[str]:
    """The texts of the elements of the same tag directly below an element."""
    cutter = Cutter(row_tag, {})
    cutter.begin(0, 0)
    start = cutter.end_of_start(text, 0)
    found = []
    for number, piece in enumerate(text[start:].split(cutter.begin_of_end)):
        found += [child for _, child, _ in cutter.feed(piece, number > 0)]
    return found


def scan_tree(
    spark: SparkSession,
    paths: str | list[str],
    row_tag: str,
    schema: T.StructType | str,
    *,
    id_field: str = "_id",
    ancestors: Mapping[str, tuple[str, str]] | None = None,
    ignore_namespace: bool = False,
    folder: str | None = None,
    **options,
) -> DataFrame:
    """A row for each element of ``row_tag``, however deep it lies in others of its tag.

    ``schema`` is of one level; elements of the tag inside an element are rows of their own.
    Added columns: ``node``, unique among the rows, ``parent_node`` (null for an outermost
    element), ``level`` (from 1) and ``id_path``, the values of ``id_field`` from the outermost
    element to this one, a missing one as "". ``ancestors`` are those of the outermost element. Other options are those of
    ``scan_elements``. What is returned reads the rounds' rows in ``folder``.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    folder = folder or new_folder(spark, "tree")
    around = list(ancestors or {})
    level = scan_elements(
        spark, paths, row_tag, schema, ancestors=ancestors, ignore_namespace=ignore_namespace,
        with_text=True, folder=f"{folder}/scan", **options,
    )
    number = F.monotonically_increasing_id().cast("string")
    level = level.withColumns(
        {
            NODE: number,
            PARENT: F.lit(None).cast("string"),
            LEVEL: F.lit(1),
        }
    ).withColumn(PATH, F.array(_own_id(id_field)))
    columns = [*schema.names, *around, NODE, PARENT, LEVEL, PATH]
    made = None
    for round_ in count():
        level.write.parquet(f"{folder}/level-{round_}")
        level = spark.read.parquet(f"{folder}/level-{round_}")
        if made is not None and level.isEmpty():
            return made
        rows = level.select(*map(top, columns))
        made = rows if made is None else made.unionAll(rows)
        level = _below(level, row_tag, schema, around, ignore_namespace)
        path = F.concat(PATH, F.array(_own_id(id_field)))
        level = level.withColumn(PATH, path)


def _own_id(name: str) -> Column:
    return F.coalesce(top(name).cast("string"), F.lit(""))


def _below(
    level: DataFrame, row_tag: str, schema: T.StructType, around: list[str], ignore_namespace: bool
) -> DataFrame:
    """The elements directly below those of a level, with the paths of these."""
    ship_library(level.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(TEXT).to_pylist()
            found = [children(text, row_tag) if text else [] for text in texts]
            kept = batch.drop_columns([TEXT])
            yield kept.append_column("texts", pa.array(found, pa.list_(pa.string())))

    fields = [f for f in level.schema.fields if f.name in {*around, NODE, LEVEL, PATH}]
    # Most elements have none below; they are not sent to Python.
    inside = level.filter(F.expr(f"instr(substr({TEXT}, 2), '<{row_tag}') > 0"))
    inside = inside.select(*[top(f.name) for f in fields], TEXT)
    out = T.StructType([*fields, T.StructField("texts", T.ArrayType(T.StringType()))])
    found = inside.mapInArrow(cut, out).select(
        *map(top, around),
        F.col(NODE).alias(PARENT),
        (F.col(LEVEL) + 1).alias(LEVEL),
        PATH,
        F.posexplode("texts").alias("place", TEXT),
    )
    # The children of one element are dealt to all tasks.
    found = found.withColumn(NODE, F.concat_ws(".", PARENT, "place")).drop("place")
    found = found.hint("rebalance")
    text_schema, types = text_attributes(schema)
    options = {"ignoreNamespace": "true"} if ignore_namespace else {}
    others = [*around, NODE, PARENT, LEVEL, PATH, TEXT]
    parsed = F.from_xml(TEXT, text_schema, options).alias("parsed row")
    parsed = found.select(parsed, *map(top, others))
    fields = {n: F.col(f"`parsed row`.{quote_path([n])}") for n in schema.names}
    made = [
        (typed(c, types[n]) if n in types else c).alias(n) for n, c in fields.items()
    ]
    return parsed.select(*made, *map(top, others))
