"""Every query against its SQL, on the given tables and on tables with a hot key."""

from __future__ import annotations

import contextlib
import io
import re
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from nestflow.queries import ORACLES, QUERIES
from tools.check import compare, duck

TABLES = "/root/testdata/sf0.001"
SKEWED = ["scan_xml", "inventory_flat", "inventory_fragments", "job_daily"]
SKEWED += [name for name in QUERIES if name.startswith("step_join")]

pytestmark = pytest.mark.skipif(not Path(TABLES).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Tables where one order has a third of all lines, half of them exact copies."""
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        source = f"SELECT * FROM '{path}'"
        if path.stem == "lineitem":
            numbered = f"SELECT *, row_number() OVER () AS n FROM '{path}'"
            source = f"""
                SELECT * EXCLUDE n REPLACE (5 AS l_orderkey) FROM ({numbered}) WHERE n % 6 = 0
                UNION ALL
                SELECT first.* EXCLUDE n REPLACE (5 AS l_orderkey)
                FROM ({numbered}) first, ({numbered}) other WHERE first.n = 1 AND other.n % 6 = 3
                UNION ALL
                SELECT * EXCLUDE n FROM ({numbered}) WHERE n % 3 <> 0
            """
        connection.execute(f"COPY ({source}) TO '{folder}/{path.name}'")
    return str(folder)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, TABLES)
    assert compare(df, duck(TABLES), name) is None
    assert_no_bottleneck(df)


def assert_no_bottleneck(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    plan = text.getvalue()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"\bPython|Pandas|Arrow", plan)
    # Only totals, already summed up by task, may go to one task.
    for line in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "partial_" in line


@pytest.mark.parametrize("name", SKEWED)
def test_query_on_skewed_tables(spark, skewed, name):
    assert compare(QUERIES[name](spark, skewed), duck(skewed), name) is None


@pytest.fixture(scope="module")
def later(tmp_path_factory):
    """Tables with a renamed region and a tenth of the orders twenty years later."""
    folder = tmp_path_factory.mktemp("later")
    connection = duckdb.connect()
    changed = {
        "orders": "CASE WHEN o_orderkey % 10 = 3 THEN o_orderdate + INTERVAL 20 YEAR "
        "ELSE o_orderdate END AS o_orderdate",
        "region": "CASE r_name WHEN 'ASIA' THEN 'OCEANIA' ELSE r_name END AS r_name",
    }
    for path in Path(TABLES).glob("*.parquet"):
        replaced = f"REPLACE ({changed[path.stem]})" if path.stem in changed else ""
        connection.execute(f"COPY (SELECT * {replaced} FROM '{path}') TO '{folder}/{path.name}'")
    return str(folder)


LANDED = ["scan_tech_filter", "scan_market_fanout", "scan_empty_partition", "output_name"]
LANDED += ["job_daily", "tech_dispatch", "ingest_report", "ingest_report_corrupt"]


@pytest.mark.parametrize("name", LANDED)
def test_query_on_other_markets_and_days(spark, later, name):
    assert compare(QUERIES[name](spark, later), duck(later), name) is None


def test_entry(spark):
    assert entry(spark).count() > 0
