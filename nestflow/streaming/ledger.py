"""Scheduled runs over files that keep arriving, with a ledger of what was taken.

A run lists the files, leaves out what the ledger has with the same path, size and time of
change, by a join on the cluster, and takes the rest in batches of bounded size. A batch's rows
go to a folder of their own; then the ledger gets its files, which is what makes the batch
count. A run that is cut short leaves a folder that the next run writes over. A file that was
rewritten is taken again, and its earlier rows no longer count. The driver holds the paths of
one batch.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestflow.operators import apply_steps
from nestflow.sinks.parquet import PARTITIONS
from nestflow.sinks.publish import Folder
from nestflow.sources.elements import files_read, scan_elements
from nestflow.sources.landing import Landing, add_origin
from nestflow.sources.xml import CORRUPT, SOURCE_FILE, list_files
from nestflow.workspace import drop_folder, new_folder

BATCH = "batch"
_LEDGER = f"{SOURCE_FILE} string, bytes bigint, modified timestamp, complete boolean, {BATCH} int"


def take_new_files(
    spark: SparkSession,
    landing: Landing,
    path: str,
    row_tag: str,
    schema: T.StructType | str,
    output: str,
    files_per_batch: int = 10_000,
    **options,
) -> DataFrame:
    """Take the files below ``path`` that are new or changed, and return the ledger.

    Rows have their origin and the text of records that do not fit the schema or that a file's
    end cuts off; the ledger says of each file whether it was ``complete``, null if nothing of
    it could be read. ``output`` holds rows and ledger; read it by ``taken_rows``. Runs of one
    output must not overlap. ``options`` are those of ``scan_elements``.
    """
    where = Folder(spark, output)
    while Folder(spark, path).exists(""):
        stage = new_folder(spark, "batch")
        try:
            same = [SOURCE_FILE, "bytes", "modified"]
            # A file that is empty yet is taken when it is not.
            new = list_files(spark, [path]).filter("bytes > 0")
            new = new.join(ledger(spark, output), same, "left_anti").select(*same)
            new.orderBy(SOURCE_FILE).limit(files_per_batch).write.parquet(f"{stage}/files")
            new = spark.read.parquet(f"{stage}/files")
            paths = [row[SOURCE_FILE] for row in new.select(SOURCE_FILE).collect()]
            if not paths:
                break
            known = where.names(f"ledger/{BATCH}=*")
            number = 1 + max((int(name.split("=")[1]) for name in known), default=-1)
            reader = spark.read.option("ignoreCorruptFiles", True)
            rows = scan_elements(
                spark,
                [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths],
                row_tag,
                schema,
                keep_corrupt=True,
                with_file=True,
                reader=reader.option("ignoreMissingFiles", True),
                folder=f"{stage}/scan",
                **options,
            )
            rows = add_origin(rows, landing)
            rows.write.mode("overwrite").parquet(f"{output}/rows/{BATCH}={number}")
            taken = new.join(files_read(spark, f"{stage}/scan"), SOURCE_FILE, "left")
            place = f"{BATCH}={number}"
            taken.coalesce(1).write.mode("overwrite").parquet(f"{output}/staged-ledger/{place}")
            # Counts from here on.
            where.move(f"staged-ledger/{place}", f"ledger/{place}")
        finally:
            drop_folder(spark, stage)
    return ledger(spark, output)


def ledger(spark: SparkSession, output: str) -> DataFrame:
    """The files taken: a row for each version of each, with its batch."""
    if not Folder(spark, output).names(f"ledger/{BATCH}=*"):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{output}/ledger")


def taken_rows(spark: SparkSession, output: str, after: int = -1) -> DataFrame:
    """The rows of the last version of each file, of batches after ``after``."""
    batches = [n for n in Folder(spark, output).names(f"ledger/{BATCH}=*")]
    numbers = [int(n.split("=")[1]) for n in batches if int(n.split("=")[1]) > after]
    if not numbers:
        raise ValueError(f"{output} has no batch after {after}")
    rows = spark.read.option("basePath", f"{output}/rows").parquet(
        *[f"{output}/rows/{BATCH}={n}" for n in numbers]
    )
    known = ledger(spark, output)
    last = known.groupBy(SOURCE_FILE).agg(F.max(BATCH).alias("last"))
    old = known.join(last, SOURCE_FILE).filter(F.col(BATCH) < F.col("last"))
    # Few files are written again.
    return rows.join(old.select(SOURCE_FILE, BATCH), [SOURCE_FILE, BATCH], "left_anti").select(
        rows.columns
    )


def flatten_taken(
    spark: SparkSession, output: str, steps: Sequence[dict], after: int = -1
) -> DataFrame:
    """The flat rows of what counts, by a list of steps, as if each file were alone."""
    rows = taken_rows(spark, output, after).drop(BATCH)
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return apply_steps(good, steps, carry=[SOURCE_FILE, *PARTITIONS])
