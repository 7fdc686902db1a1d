"""Daily job: ``spark-submit daily_job.py 2018-01-31 --input <folder> --output <folder>``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stayledger.operators.keys import BOOKING
from stayledger.operators.measures import EUR_NAMES, UNCONVERTED
from stayledger.plans import jobs
from stayledger.plans.extract import base_bookings, extract_of, few_bookings
from stayledger.settings import apply_settings
from stayledger.sources.catalog import Reader, load_books
from stayledger.sources.materialize import materialized_while
from stayledger.sources.sinks import Written, write_extract


def run(spark: SparkSession, run_date: date, read: Reader, target: str, formats: tuple[str, ...], top: int | None) -> Written:
    """Write the extract of a date; tell its rows, its totals in euros and how many cost lines had no rate."""
    # Read once: the day filters, prices and joins, and must be the same each time.
    with materialized_while(base_bookings(read("booking_interface"), run_date, top)) as day:
        span = day.agg(F.min(BOOKING[1]), F.max(BOOKING[1])).first()
        extract = extract_of(few_bookings(load_books(read), day, tuple(span)), day, count_unconverted=True)
        figures = {name: F.sum(name) for name in (*EUR_NAMES.values(), UNCONVERTED)}
        return write_extract(extract, target, run_date, formats, figures, [UNCONVERTED])


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("run_date", type=date.fromisoformat)
    jobs.add_arguments(parser)
    parser.add_argument("--top", type=int, help="only the first bookings by key")
    arguments = parser.parse_args()
    spark = apply_settings(SparkSession.builder.appName("daily extract").getOrCreate())
    read = jobs.reader(spark, arguments)
    written = run(spark, arguments.run_date, read, arguments.output, tuple(arguments.format), arguments.top)
    jobs.tell(str(arguments.run_date), written)
    spark.stop()


if __name__ == "__main__":
    main()
