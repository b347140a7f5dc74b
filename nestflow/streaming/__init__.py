"""Take only files that were not taken before."""

from nestflow.streaming.incremental import flatten_new_rows, ingest_new_files
from nestflow.streaming.ledger import flatten_taken, ledger, take_new_files, taken_rows

__all__ = [
    "flatten_new_rows",
    "flatten_taken",
    "ingest_new_files",
    "ledger",
    "take_new_files",
    "taken_rows",
]
