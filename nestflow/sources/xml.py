"""Read XML files: one row per element with the row tag."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.functions.naming import decoded
from nestflow.functions.paths import top

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"

log = logging.getLogger(__name__)


def scan_xml(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_tag: str = "configData",
    schema: T.StructType | str | None = None,
    *,
    ignore_namespace: bool = False,
    keep_corrupt: bool = False,
    with_file: bool = False,
    recursive: bool = False,
    name_glob: str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Scan all files at ``paths`` (globs allowed) in one read.

    Attributes become fields named ``_name``. Without a schema Spark reads the
    files once more to infer one over all of them, or over ``sampling_ratio`` of
    their records. With a schema, no match for the paths gives an empty result.
    ``with_file`` adds the path of the file.

    Spark reads one file in one task here, and ``keep_corrupt`` gives every record
    that does not fit the schema the text of its whole file. It is meant for files
    of one record; ``scan_fragments`` cuts files and keeps the record's own text.
    """
    reader = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreNamespace", ignore_namespace)
        .option("recursiveFileLookup", recursive)
    )
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if schema is None:
        df = reader.option("samplingRatio", sampling_ratio).load(paths)
        return df.withColumn(SOURCE_FILE, file_path()) if with_file else df

    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text_schema, types = text_attributes(schema)
    if keep_corrupt:
        # The reader only notices misfits in columns a query uses: write the rows
        # with all columns before good and corrupt ones go separate ways.
        text_schema = text_schema.add(CORRUPT, T.StringType())
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    try:
        df = reader.schema(text_schema).load(paths) if paths else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not isinstance(paths, str):
            raise
        df = None
    if df is None:
        log.info("no files at %s", paths)
        empty = T.StructType(text_schema.fields).add(SOURCE_FILE, T.StringType())
        df = spark.createDataFrame([], empty)
    elif with_file:
        df = df.withColumn(SOURCE_FILE, file_path())
    columns = [typed(top(n), types[n]).alias(n) if n in types else top(n) for n in schema.names]
    if keep_corrupt:
        corrupt = F.coalesce(top(CORRUPT), *[misfit(top(n), t) for n, t in types.items()])
        columns.append(corrupt.alias(CORRUPT))
    return df.select(*columns, *([SOURCE_FILE] if with_file else []))


def text_attributes(schema: T.StructType) -> tuple[T.StructType, dict[str, T.DataType]]:
    """The schema with the row's own attributes as text, and the types they should have.

    Spark's parser fails the job, in every mode, on an attribute of the row element
    that does not fit its type. As text they can be cast after, misfits becoming null.
    """
    types = {
        f.name: f.dataType
        for f in schema.fields
        if f.name.startswith("_") and f.name != "_VALUE" and f.dataType != T.StringType()
    }
    fields = [
        T.StructField(f.name, T.StringType(), True) if f.name in types else f
        for f in schema.fields
    ]
    return T.StructType(fields), types


def typed(text: Column, dtype: T.DataType) -> Column:
    return F.trim(text).try_cast(dtype)


def misfit(text: Column, dtype: T.DataType) -> Column:
    """The text of an attribute that does not fit its type, or null."""
    return F.when(typed(text, dtype).isNull(), text)


def file_path():
    return decoded(F.col("_metadata.file_path"))


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files at ``paths``, their sizes and times of change; contents are not read."""
    if not paths:
        return spark.createDataFrame([], f"{SOURCE_FILE} string, bytes long, modified timestamp")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(list(paths))
    return files.select(
        file_path().alias(SOURCE_FILE),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def narrow_schema(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """Keep only the fields on the given dotted paths, with all that lies below them.

    The XML reader builds every field of the schema it is given, also those no one
    selects, so a narrower schema is its column pruning.
    """
    wanted: dict[str, list[str]] = {}
    fields = []
    for path in paths:
        name = _longest_name(schema, path)
        wanted.setdefault(name, []).append(path[len(name) + 1 :])
    for field in schema.fields:
        if field.name in wanted:
            rest = wanted[field.name]
            dtype = field.dataType if "" in rest else _narrow_type(field.dataType, rest)
            fields.append(T.StructField(field.name, dtype, field.nullable, field.metadata))
    return T.StructType(fields)


def _narrow_type(dtype: T.DataType, paths: list[str]) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_narrow_type(dtype.elementType, paths), dtype.containsNull)
    if isinstance(dtype, T.StructType):
        return narrow_schema(dtype, paths)
    raise LookupError(f"{dtype.simpleString()} has no fields {paths}")


def _longest_name(schema: T.StructType, path: str) -> str:
    names = [n for n in schema.names if path == n or path.startswith(n + ".")]
    if not names:
        raise LookupError(f"no field {path!r}; fields are {schema.names}")
    return max(names, key=len)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and rows that do not with their text."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull())
