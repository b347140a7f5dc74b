"""The corpus pipeline: five stages, each on what the one before has kept.

A stage is a function of the session, the documents and the folder of the tables; it returns
rows, which are written as Parquet and read again as the documents of the next stage. All but
the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.llm import bpe, decontamination, line_dedup, quality_rules, simhash
from nestflow.llm.base import drop_settled, settled, settled_paths
from nestflow.llm.queries import BYTE_BPE, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` is of the rest."""
    left = line_dedup.dedup_lines(docs, least_documents=5, shortest=40)
    left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words of a benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return decontamination.drop_contaminated(docs, items, span=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of the ids and of the text they decode to."""
    coded = bpe.digests(docs, BYTE_BPE, ids="token_ids")
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("encode", encode),
]

#: SQL expresses neither the components of fingerprints nor BPE; tests/llm has a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, from the table of documents.

    When a stage's rows are written, the tables that it has made on the way are deleted, and so
    are the documents that it has read.
    """
    docs, older = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        before = settled_paths(spark)
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
        made = [path for path in settled_paths(spark) if path not in before]
        drop_settled(spark, [*made[:-1], *older])
        older = made[-1:]
    return docs
