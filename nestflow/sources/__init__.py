"""Scans: XML files by row tag, landing folders by market, technology and day."""

from nestflow.sources.elements import files_read, scan_elements, scan_named, tags_named
from nestflow.sources.fragments import scan_fragments
from nestflow.sources.inference import infer_schema
from nestflow.sources.landing import Landing, day_folders, list_days, parse_day, scan_landing
from nestflow.sources.tree import scan_tree
from nestflow.sources.xml import (
    CORRUPT,
    SOURCE_FILE,
    list_files,
    narrow_schema,
    scan_xml,
    split_corrupt,
)

__all__ = [
    "CORRUPT",
    "SOURCE_FILE",
    "Landing",
    "day_folders",
    "files_read",
    "infer_schema",
    "list_days",
    "list_files",
    "narrow_schema",
    "parse_day",
    "scan_elements",
    "scan_fragments",
    "scan_landing",
    "scan_named",
    "scan_tree",
    "scan_xml",
    "split_corrupt",
    "tags_named",
]
