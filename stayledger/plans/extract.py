"""The daily financial extract."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.functions.scalars import midnight
from stayledger.operators.keys import BOOKING, top_n
from stayledger.operators.lookup import measured
from stayledger.operators.measures import Books, with_measures

# Measures of an earlier run, recomputed here. Names match in any letter case.
EARLIER_MEASURES = (
    "Tax_Sales_Transfer_pricing",
    "Tax_Sales_Transfer_pricing_EUR",
    "Transfer_pricing",
    "tax_transfer_pricing_eur",
    "Tax_Cost_Transfer_pricing",
    "Tax_Cost_Transfer_pricing_EUR",
)

# Dates delivered as midnight timestamps.
DATE_FIELDS = (
    "creation_date",
    "modification_date",
    "cancellation_date",
    "status_date",
    "booking_service_from",
    "booking_service_to",
)


def without_measures(bookings: DataFrame) -> DataFrame:
    return bookings.drop(*EARLIER_MEASURES)


def base_bookings(view: DataFrame, run_date: date | None, top: int | None = None) -> DataFrame:
    """Bookings created on the run date, or all of them; the date reaches the scan."""
    day = view if run_date is None else view.filter(F.col("creation_date") == F.lit(run_date))
    return top_n(without_measures(day), list(BOOKING), top)


def assemble(base: DataFrame, *measures: DataFrame) -> DataFrame:
    """Inner join of the base with measure frames on the booking key."""
    return reduce(lambda left, right: left.join(right, list(BOOKING)), measures, base)


def with_midnights(extract: DataFrame) -> DataFrame:
    return extract.withColumns({name: midnight(F.col(name)) for name in DATE_FIELDS})


def extract_of(books: Books, base: DataFrame, count_unconverted: bool = False) -> DataFrame:
    """The base bookings with all measures and midnight dates."""
    return with_midnights(with_measures(books, base, count_unconverted=count_unconverted))


def few_bookings(books: Books, base: DataFrame, span: tuple[int, int] | None = None) -> Books:
    """Books narrowed to a selection of bookings, of numbers in ``span`` if that is known."""
    return books.scoped(measured(base.select(*BOOKING)), span)


def build_extract(books: Books, view: DataFrame, run_date: date | None = None, top: int | None = None) -> DataFrame:
    """Bookings of a date with all measures. One plan, to be written once."""
    base = base_bookings(view, run_date, top)
    whole = run_date is None and top is None
    return extract_of(books if whole else few_bookings(books, base), base)
