"""Parquet output and the report on an ingest."""

from nestflow.sinks.parquet import SAVE_MODES, write_parquet, write_partitioned
from nestflow.sinks.publish import Publication, finish, read_days
from nestflow.sinks.report import ingest_report

__all__ = [
    "SAVE_MODES",
    "Publication",
    "finish",
    "ingest_report",
    "read_days",
    "write_parquet",
    "write_partitioned",
]
