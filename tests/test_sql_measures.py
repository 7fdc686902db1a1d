"""Measures as SQL text against their DataFrame form."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stayledger.operators.keys import in_scope
from stayledger.operators.lookup import Lookup
from stayledger.operators.measures import booking_taxes
from stayledger.plans.sql_measures import TAXES, SqlMeasures
from tests.frames import book_rows, booking, books, frame

CAMPAIGN = {"extra_bonds": [(1, 1, 1, 10, "A"), (1, 2, 3, 10, "A")], "discount_bonds": [(10, "A", "BAD")], "campaigns": [("BAD", "A", "N")]}


def amounts(taxes):
    return {(r["seq_rec"], r["seq_reserva"]): (pytest.approx(r["sales_tax"]), pytest.approx(r["cost_tax"])) for r in taxes.collect()}


def test_taxes_by_sql_are_those_of_the_frames(spark):
    services, _ = book_rows()
    given = books(spark, services, **CAMPAIGN)
    days = [booking(1, n, created=date(1996, 5, 1 + n % 4), ccy=("EUR", "USD")[n % 2]) for n in range(15)]
    view = frame(spark, "booking_interface", days)
    by_sql = SqlMeasures(spark, given, view, "one_")
    wanted = view.where(F.col("creation_date").between("1996-05-02", "1996-05-03"))
    scoped = in_scope(booking_taxes(given), Lookup(wanted.select("operative_incoming", "booking_id"), True), "seq_rec", "seq_reserva")
    got = by_sql.taxes(date(1996, 5, 2), date(1996, 5, 3))
    assert amounts(got) == amounts(scoped) != {}
    daily = {(r["creation_date"], r["booking_currency"]): r["bookings"] for r in by_sql.taxes_by_day(date(1996, 5, 1), date(1996, 5, 9)).collect()}
    assert sum(daily.values()) == 15 and len(daily) == 4

    # Another instance has views of its own.
    other = SqlMeasures(spark, books(spark), view, "two_")
    assert other.taxes(date(1996, 5, 1), date(1996, 5, 9)).count() == 0 and amounts(got) == amounts(scoped)
    with pytest.raises(Exception):
        by_sql.statement(TAXES, lines="service_hotel")


def test_exclusions_and_days_are_looked_up_once_for_all_tables(spark):
    services, _ = book_rows()
    by_sql = SqlMeasures(spark, books(spark, services, **CAMPAIGN), frame(spark, "booking_interface", [booking(1, 1)]), "three_")
    text = by_sql.taxes(date(1996, 5, 1), date(1996, 5, 9))._jdf.queryExecution().optimizedPlan().toString()
    # The exclusions themselves are two semi joins.
    assert text.count("LeftAnti") == 1 and text.count("LeftSemi") == 3
