"""Every operator as a query over the given tables, with SQL that gives the same rows."""

from nestflow.queries import jobs, scans, sinks, steps
from nestflow.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "jobs", "scans", "sinks", "steps"]
