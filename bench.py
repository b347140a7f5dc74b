"""Time the headline queries and print one JSON line.

Fixtures (XML written from the tables) are made first and timed apart: they stand for
data that a user already has.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from nestflow.queries import QUERIES, fixtures  # noqa: E402

HEADLINE = [
    "inventory_flat",
    "inventory_fragments",
    "inventory_deep",
    "example_flow",
    "job_daily",
    "scan_xml",
    "scan_xml_fragments",
    "scan_xml_nested",
    "scan_xml_any_prefix",
    "scan_xml_inferred",
    "scan_date_range",
    "scan_incremental",
    "read_quarantine",
    "write_partitioned",
    "step_select_star",
    "step_explode_outer",
    "step_join_inner",
    "step_join_full",
    "step_join_semi",
    "step_join_range",
    "step_group_agg",
    "step_group_agg_more",
    "step_order_by",
    "step_distinct",
]
FIXTURES = [
    "orders_nested",
    "orders_xml",
    "dirty_xml",
    "cut_off_xml",
    "landing_tree",
    "inventory_xml",
    "deep_inventory_xml",
    "nested_tag_xml",
    "prefixed_xml",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    def drain(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    setup = {n: seconds(lambda: getattr(fixtures, n)(spark, sf_dir)) for n in FIXTURES}
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        timings[name] = seconds(lambda: drain(name))
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "setup": setup,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
