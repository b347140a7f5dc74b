"""A scheduled run as a file stream: the checkpoint remembers what was taken.

Each function takes what is there, in batches, and returns. A batch that is cut short
is done again without doubled rows. Output and checkpoint belong together, and both
must be folders that all executors share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.operators import apply_steps
from nestflow.sinks.parquet import PARTITIONS
from nestflow.sources.fragments import scan_fragments
from nestflow.sources.landing import Landing, add_origin
from nestflow.sources.xml import CORRUPT, SOURCE_FILE


def ingest_new_files(
    spark: SparkSession,
    landing: Landing,
    path: str,
    row_tag: str,
    schema: T.StructType | str,
    output: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
    oldest: str = "36500d",
    **options,
) -> None:
    """Append the nested rows of all files below ``path`` not seen by this checkpoint.

    Rows have their origin, and the text of records that do not fit the schema. Files count
    as new by their path, whatever their date, unless they are older than ``oldest`` against
    the newest file: Spark forgets such files, and keeps the names of all others in its
    checkpoint and in the driver's memory. A record that a file's end cuts off is not told
    from a whole one here. ``options`` are those of ``scan_fragments``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    reader = reader.option("maxFileAge", oldest)
    rows = scan_fragments(
        spark,
        path,
        row_tag,
        schema,
        keep_corrupt=True,
        with_file=True,
        recursive=True,
        reader=reader,
        **options,
    )
    _append(add_origin(rows, landing), output, checkpoint)


def flatten_new_rows(
    spark: SparkSession, ingested: str, steps: Sequence[dict], output: str, checkpoint: str
) -> None:
    """Append the flat rows of what ``ingest_new_files`` wrote since the last call.

    Steps that need all rows, such as a sort or groups, are for tables, not for streams.
    """
    schema = spark.read.parquet(ingested).schema
    rows = spark.readStream.schema(schema).parquet(ingested)
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    _append(apply_steps(good, steps, carry=[SOURCE_FILE, *PARTITIONS]), output, checkpoint)


def _append(rows: DataFrame, output: str, checkpoint: str) -> None:
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(output).awaitTermination()
