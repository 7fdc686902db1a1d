"""Line store: ``spark-submit store_job.py --input <folder> --output <folder> --buckets service=2000 cost=1000 sale=1000``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stayledger.plans import jobs
from stayledger.settings import apply_settings
from stayledger.sources.store import LINE_TABLES, LineStore, write_lines


def parse_buckets(text: str) -> tuple[str, int]:
    name, many = text.split("=")
    if name not in LINE_TABLES or int(many) < 1:
        raise argparse.ArgumentTypeError(f"one of {', '.join(LINE_TABLES)} and a number, got {text}")
    return name, int(many)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs.add_arguments(parser)
    parser.add_argument("--buckets", nargs="+", type=parse_buckets, required=True, metavar="TABLE=N")
    arguments = parser.parse_args()
    spark = apply_settings(SparkSession.builder.appName("line store").getOrCreate())
    write_lines(LineStore(spark, arguments.output), jobs.reader(spark, arguments), dict(arguments.buckets))
    spark.stop()


if __name__ == "__main__":
    main()
