"""Flatten the XML of a window of days: ``spark-submit run_job.py --help``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from nestflow.config import JobConfig
from nestflow.plans import run_job
from nestflow.sources import parse_day


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config", default="config.yaml", help="YAML configuration")
    parser.add_argument("--start-date", required=True, type=parse_day, help="YYYYMMDD")
    parser.add_argument("--end-date", required=True, type=parse_day, help="YYYYMMDD, included")
    parser.add_argument("--lm", required=True, help="local markets, separated by commas")
    parser.add_argument("--techs", required=True, help="technologies, separated by commas")
    parser.add_argument("--quarantine", help="folder for records that cannot be read")
    parser.add_argument("--report", help="folder for the report on each file")
    args = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)

    spark = SparkSession.builder.appName("nestflow").getOrCreate()
    report = run_job(
        spark,
        JobConfig.from_yaml(args.config),
        args.lm.split(","),
        args.techs.split(","),
        args.start_date,
        args.end_date,
        quarantine=args.quarantine,
        report=args.report,
    )
    report.groupBy("tech", "status").count().show(truncate=False)


if __name__ == "__main__":
    main()
    SparkSession.active().stop()
