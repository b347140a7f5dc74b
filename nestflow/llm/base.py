"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.workspace import drop_folder, new_folder, ship_library

#: Spaces between words, in Java's and RE2's patterns: what ``bytes.split()`` splits at.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Texts that Python holds as words, pieces or hashes at one time. Workers of one executor
#: share its memory, and these take many times a text's bytes.
BLOCK_BYTES = 1 << 20


def settled(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows, written to the shared folder: later jobs read them, none makes them again.

    A lost executor cannot change them, and the lineage ends here. The folder stays for as
    long as results may read it: see ``drop_settled``.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_settled: dict[str, list[str]] = {}


def settled_paths(spark: SparkSession) -> list[str]:
    """Folders of this application's written tables, the last one last."""
    return list(_settled.get(spark.sparkContext.applicationId, ()))


def drop_settled(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written tables that nothing reads any more: those of an operator may go when
    its result is written."""
    known = _settled.get(spark.sparkContext.applicationId, [])
    for path in paths:
        if path in known:
            known.remove(path)
            drop_folder(spark, path)


def text_key(column: str = "text") -> F.Column:
    """A hash that is not null and tells null from empty: a text's names a row beside its id."""
    return F.xxhash64(F.col(column).isNull(), F.col(column))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of Arrow's batches, so that Python holds few of their texts at one time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow``, with this library on the executors wherever they are started."""
    ship_library(df.sparkSession)
    return df.mapInArrow(function, schema)


def map_rows(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]],
) -> DataFrame:
    """``mapInArrow`` by a function of one batch, made once per task; yields columns."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches):
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [_array(columns[f.name], f.type) for f in arrow], schema=arrow
                )

    return map_batches(df, run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, np.ndarray):
        return pa.array(values).cast(kind)
    return pa.array(values, type=kind)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def fields(df: DataFrame) -> list[str]:
    """The columns as DDL."""
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
