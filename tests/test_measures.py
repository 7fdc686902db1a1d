"""Measures over hand-written books: edge rows and invariants."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stayledger.operators import lines, measures
from stayledger.operators.lookup import Lookup
from stayledger.plans.extract import build_extract
from tests.frames import TAX, book_rows, booking, books, cost, frame, line


def totals(frame_, key="seq_reserva"):
    return {row[key]: row for row in frame_.collect()}


def bookings(spark, *rows):
    return frame(spark, "booking_interface", list(rows))


def test_regimes_and_missing_amounts(spark):
    given = books(
        spark,
        {
            "hotel": [
                line(1, 1, fac="E", con="E"),
                line(1, 2),
                line(1, 3, fac=None, con=None),
                line(1, 4, venta=None, canco=None),
                line(1, 5, code="9"),
                line(1, 6, code="404"),
            ]
        },
    )
    got = totals(measures.booking_taxes(given))
    assert got[1]["sales_tax"] == pytest.approx(2.0) and got[1]["cost_tax"] == pytest.approx(1.0)
    assert got[2]["sales_tax"] == pytest.approx(2.0) and got[2]["cost_tax"] == pytest.approx(1.0)
    assert got[3]["sales_tax"] == pytest.approx(2.0)
    assert (got[4]["sales_tax"], got[4]["cost_tax"]) == (0, 0)
    assert (got[5]["sales_tax"], got[5]["cost_tax"]) == (0, 0)
    assert 6 not in got


@pytest.mark.parametrize("small", [True, False])
def test_duplicate_tax_rows(spark, small):
    tax = [*TAX, ("J", "8", "C", "S", "E", 11.0)]
    given = books(spark, {"hotel": [line(1, 1)]}, tax=tax, small=small)
    five = lines.with_tax(given.lines, given.tax).collect()
    assert [(row["pct_vta"], row["pct_cpa"]) for row in five] == [(25.0, 25.0)]
    four = lines.with_tax(given.lines, given.tax, tax_type_on_sales_join=False).collect()
    assert sorted((row["pct_vta"], row["pct_cpa"]) for row in four) == [(11.0, 25.0), (25.0, 25.0)]


@pytest.mark.parametrize("small", [True, False])
def test_only_extras_of_unprofitable_campaigns_are_excluded(spark, small):
    given = books(
        spark,
        {"extra": [line(1, 1, extra=n) for n in (1, 2, 3, 4)], "hotel": [line(1, 1)]},
        costs=[cost(1, 1, extra=1), cost(1, 1, extra=2), cost(1, 1)],
        extra_bonds=[(1, 1, 1, 10, "A"), (1, 1, 2, 20, "A"), (1, 1, 3, 10, "B"), (2, 1, 4, 10, "A")],
        discount_bonds=[(10, "A", "BAD"), (20, "A", "GOOD"), (10, "B", "BAD")],
        campaigns=[("BAD", "A", "N"), ("GOOD", "A", "S"), ("BAD", "B", "S")],
        small=small,
    )
    assert [tuple(row) for row in given.exclusions().orderBy("seq_rec").collect()] == [(1, 1, 1), (2, 1, 4)]
    assert totals(measures.booking_taxes(given))[1]["sales_tax"] == pytest.approx(4 * 2.0)
    costs = measures.included_costs(given).collect()
    assert [(row["nights"], row["cost_lines"]) for row in costs] == [(40.0, 2)]


def test_exclusion_removes_all_lines_of_the_extra_and_splits_the_rest(spark):
    given = books(
        spark,
        {"extra": [line(1, 1, extra=1), line(1, 1, extra=1), line(1, 2, extra=1)]},
        extra_bonds=[(1, 1, 1, 10, "A")],
        discount_bonds=[(10, "A", "BAD")],
        campaigns=[("BAD", "A", "N")],
    )
    excluded = given.exclusions()
    kept = given.lines.join(excluded, ["seq_rec", "seq_reserva", "ord_extra"], "left_anti").count()
    dropped = given.lines.join(excluded, ["seq_rec", "seq_reserva", "ord_extra"], "left_semi").count()
    assert (kept, dropped, given.lines.count()) == (1, 2, 3)
    assert set(totals(measures.booking_taxes(given))) == {2}


def test_costs_convert_filter_and_count_unconverted(spark):
    given = books(
        spark,
        costs=[
            cost(1, 1, amount=10.0, ccy="USD"),
            cost(1, 1, amount=5.0, ccy="XXX"),
            cost(1, 1, amount=100.0, kind="BT"),
            cost(1, 1, amount=100.0, billable="N"),
            cost(1, 2, amount=3.0, ccy="USD"),
            cost(9, 9, amount=3.0, ccy="USD"),
        ],
    )
    view = bookings(spark, booking(1, 1, "EUR"), booking(1, 2, "USD", date(1995, 1, 1)))
    priced = measures.priced_bookings(view, given.fx)
    got = totals(measures.cost_by_booking(given, priced))
    assert got[1]["cost_field"] == pytest.approx(20 * 0.78) and got[1]["unconverted_lines"] == 1
    assert got[2]["cost_field"] == 0 and got[2]["unconverted_lines"] == 1
    assert set(got) == {1, 2}
    with pytest.raises(ValueError):
        measures.cost_by_booking(given, priced, "USD")


def test_every_booking_is_kept_with_zero_for_what_it_lacks(spark):
    given = books(spark, {"hotel": [line(1, 1), line(1, 3)]}, costs=[cost(1, 2), cost(1, 3)])
    view = bookings(spark, *(booking(1, n) for n in (1, 2, 3, 4)))
    got = totals(measures.with_measures(given, view), "booking_id")
    assert {n: float(row["tax_sales_transfer_pricing"]) for n, row in got.items()} == {1: 2, 2: 0, 3: 2, 4: 0}
    assert {n: float(row["tax_cost_transfer_pricing"]) for n, row in got.items()} == {1: 1, 2: 20, 3: 21, 4: 0}
    assert {n: float(row["transfer_pricing"]) for n, row in got.items()} == {1: 3, 2: 20, 3: 23, 4: 0}


def test_total_filled_before_or_after(spark):
    table = spark.createDataFrame([(1.0, None), (None, None), (1.0, 2.0)], "a double, b double")
    safe = measures.null_safe_total(table, "a", "b", "t").collect()
    lossy = measures.null_safe_total(table, "a", "b", "t", fill_each=False).collect()
    assert [row["t"] for row in safe] == [1.0, 0.0, 3.0]
    assert [row["t"] for row in lossy] == [0.0, 0.0, 3.0]


def test_transfer_price_mixes_currencies_and_rounds(spark):
    given = books(spark, {"hotel": [line(1, 1)]})
    row = measures.with_measures(given, bookings(spark, booking(1, 1, "USD"))).first()
    # 2 in dollars, plus 1 dollar of cost tax in euros at 0.78.
    assert float(row["transfer_pricing"]) == 2.78
    assert float(row["tax_transfer_pricing_eur"]) == 2.168
    yen = measures.with_measures(given, bookings(spark, booking(1, 1, "JPY"))).first()
    assert float(yen["transfer_pricing"]) == 2.0


def test_unknown_currency_is_neither_rounded_nor_converted(spark):
    given = books(spark, {"hotel": [line(1, 1, canal=10.12345, fac="E")]})
    row = measures.with_measures(given, bookings(spark, booking(1, 1, "ZZZ"))).first()
    assert float(row["tax_sales_transfer_pricing"]) == pytest.approx(2.02469)
    assert row["tax_sales_transfer_pricing_eur"] == 0


def test_empty_services(spark):
    given = books(spark)
    got = measures.with_measures(given, bookings(spark, booking(1, 1))).first()
    assert float(got["transfer_pricing"]) == 0
    assert measures.booking_taxes(given).count() == 0


def test_line_euros_are_rounded_one_by_one(spark):
    # A sales tax of 0.002 dollars is 0.00156 euros: 0.002 rounded, and 0.016 instead of 0.020 for ten lines.
    given = books(spark, {"hotel": [line(1, 1, canal=0.01, fac="E")] * 10})
    view = bookings(spark, booking(1, 1, "USD"))
    row = measures.line_level_eur(given, view, measures.SALES_TAX).first()
    assert row["tax_sales_transfer_pricing_eur"] == pytest.approx(0.02)
    costs = books(spark, costs=[cost(1, 1, amount=0.001, ccy="USD")] * 10)
    priced = measures.priced_bookings(view, costs.fx)
    assert totals(measures.cost_by_booking(costs, priced, "EUR"))[1]["cost_field"] == pytest.approx(0.02)


@pytest.mark.parametrize("measure", list(measures.EUR_NAMES))
def test_line_level_euros(spark, measure):
    given = books(spark, {"hotel": [line(1, 1), line(1, 1, fac="E")]}, costs=[cost(1, 1, ccy="USD")])
    row = measures.line_level_eur(given, bookings(spark, booking(1, 1, "USD")), measure).first()
    expected = {
        measures.SALES_TAX: 4 * 0.78,
        measures.COST_TAX: 2 * 0.78 + 20 * 0.78,
        measures.TRANSFER: 6 * 0.78 + 20 * 0.78,
    }
    assert row[measures.EUR_NAMES[measure]] == pytest.approx(expected[measure])


def test_scope_by_broadcast_or_by_the_later_join_agree(spark):
    services, costs = book_rows()
    given = books(spark, services, costs=costs)
    view = bookings(spark, *(booking(1, n) for n in range(10)))
    keys = view.select("operative_incoming", "booking_id")
    few = measures.with_measures(given.scoped(Lookup(keys, True)), view)
    many = measures.with_measures(given.scoped(Lookup(keys, False)), view)
    assert sorted(few.collect()) == sorted(many.collect())


def test_daily_extract_selects_the_day_and_its_pairs(spark):
    services, costs = book_rows()
    given = books(spark, services, costs=costs)
    view = bookings(
        spark,
        booking(1, 1, created=date(1996, 5, 1), cancelled="1996-05-03"),
        booking(2, 2, created=date(1996, 5, 1)),
        booking(1, 2, created=date(1996, 5, 2)),
    )
    got = {(row["operative_incoming"], row["booking_id"]): row for row in build_extract(given, view, date(1996, 5, 1)).collect()}
    assert set(got) == {(1, 1), (2, 2)}
    assert str(got[(1, 1)]["cancellation_date"]) == "1996-05-03 00:00:00" and got[(2, 2)]["cancellation_date"] is None
    assert float(got[(2, 2)]["transfer_pricing"]) == 0
    top = build_extract(given, view, date(1996, 5, 1), top=1).collect()
    assert [(row["operative_incoming"], row["booking_id"]) for row in top] == [(1, 1)]
