"""Column helpers: nested paths, and names taken from a file's path."""

from nestflow.functions.naming import day_of, market_of, output_name, tech_of
from nestflow.functions.paths import column_at, find_path, quote_path, sql_text

__all__ = [
    "column_at",
    "day_of",
    "find_path",
    "market_of",
    "output_name",
    "quote_path",
    "sql_text",
    "tech_of",
]
