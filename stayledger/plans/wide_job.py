"""Wide extract: ``spark-submit wide_job.py 2018-01-31 "2018-01-31 00:00:00" "2018-01-31 23:59:59" --input <folder> --output <folder>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators.header import KEY
from stayledger.operators.lookup import measured
from stayledger.operators.measures import UNCONVERTED
from stayledger.operators.sales import tax_ttv, ttv_by_booking
from stayledger.plans import jobs
from stayledger.plans.wide import build_wide_extract
from stayledger.settings import apply_settings
from stayledger.sources.catalog import Reader, load_header_tables
from stayledger.sources.sinks import Written, write_extract


# Totals of the sale lines and the names they get next to those of the views.
SALE_TOTALS = {"TTV_booking_currency": "sale_ttv", "Tax_TTV": "sale_tax_ttv", "Tax_TTV_TOMS": "sale_tax_ttv_toms"}


def with_sale_totals(extract: DataFrame, read: Reader) -> DataFrame:
    """The extract with value and taxes worked out from the sale lines next to those of the views."""
    bookings = read("booking").select(*KEY, "ind_tippag")
    value = ttv_by_booking(read("sale"), bookings).drop("ind_tippag")
    taxes = tax_ttv(read("sale"), measured(read("tax")), bookings).drop("ind_tippag")
    totals = value.join(taxes, list(KEY)).withColumnsRenamed(SALE_TOTALS)
    joined = extract.join(totals, list(KEY), "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0.0)) for name in SALE_TOTALS.values()})


def run(
    spark: SparkSession, run_date: date, start: str, end: str, read: Reader, views: Sequence[str], target: str, formats: tuple[str, ...]
) -> Written:
    """Write the wide extract of the bookings created in a timestamp range; tell its rows, totals and how many measures had no rate."""
    extract = with_sale_totals(build_wide_extract(load_header_tables(read, views), start, end, count_unconverted=True), read)
    figures = {name: F.sum(name) for name in (*SALE_TOTALS.values(), UNCONVERTED)}
    return write_extract(extract, target, run_date, formats, figures, [UNCONVERTED])


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("run_date", type=date.fromisoformat)
    parser.add_argument("start")
    parser.add_argument("end")
    parser.add_argument("--views", nargs="+", required=True, help="per-booking measure views")
    jobs.add_arguments(parser)
    arguments = parser.parse_args()
    spark = apply_settings(SparkSession.builder.appName("wide extract").getOrCreate())
    read = jobs.reader(spark, arguments)
    formats = tuple(arguments.format)
    written = run(spark, arguments.run_date, arguments.start, arguments.end, read, arguments.views, arguments.output, formats)
    jobs.tell(f"{arguments.start} to {arguments.end}", written)
    spark.stop()


if __name__ == "__main__":
    main()
