"""Header fields and the wide extract over hand-written tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stayledger.operators import header
from stayledger.operators.lookup import Lookup, fixed
from stayledger.plans import wide
from stayledger.plans.wide import (
    BOOKING_CURRENCY_MEASURES,
    EUR_MEASURES,
    build_wide_extract,
    wide_fields,
    with_daily_rate,
)
from stayledger.sources.catalog import load_header_tables
from stayledger.sources.schemas import SCHEMAS
from tests.frames import frame

DAY = datetime(2018, 1, 10, 12, 30)

OTHER_MEASURES = [
    name
    for name in (*(row[2] for row in BOOKING_CURRENCY_MEASURES), *(row[1] for row in EUR_MEASURES))
    if name not in ("ttv", "platform_fee_eur")
]


def booking(res, operator=1, country="ES", office=1, invoicing=1, interface="A", cancelled=None, payment=None):
    given = {
        "grec_seq_rec": office,
        "seq_reserva": res,
        "gdiv_cod_divisa": "USD",
        "fec_creacion": DAY,
        "fec_cancelacion": cancelled,
        "fec_desde": DAY,
        "fec_hasta": DAY,
        "gtto_seq_ttoo": operator,
        "cod_pais_cliente": country,
        "fint_cod_interface": interface,
        "seq_rec_invoicing": invoicing,
        "nom_general": "a;b",
        "ind_tippag": payment,
    }
    names = [part.split()[0] for part in SCHEMAS["booking"].split(",")]
    return tuple(given.get(name) for name in names)


ROWS = {
    "booking": [
        booking(1),
        booking(2, country=None, invoicing=9, interface="Z"),
        booking(3, operator=7),
        booking(4, country="XX"),
        booking(5, cancelled=DAY, payment="H"),
        booking(0),
    ],
    "tour_operator": [(1, "One", "FR"), (2, "Two", "ES")],
    "country": [("ES", "es"), ("FR", "fr")],
    "receptive": [(1, "C1", "O1", "Office")],
    "interface": [("A", "partner")],
    "booking_information": [
        (1, 1, datetime(2018, 1, 2), "A", "late"),
        (1, 1, datetime(2018, 1, 1), "A", "early"),
        (1, 1, datetime(2017, 1, 1), "B", "other"),
    ],
    "hotel_sale": [(1, 1, 20, None), (1, 1, 10, DAY), (1, 1, 30, None), (1, 2, 30, None)],
    "hotel_master": [(10, "D1"), (20, "D2"), (30, "NOWHERE")],
    "destination": [("D1", "Palma", "ENG"), ("D1", "Palma_ES", "SPA"), ("D2", "Rome", "ENG"), ("D3", "Oslo", "ENG")],
    "other_service": [(1, 1, "K", "T", date(2018, 1, 1)), (1, 2, "K", "T", date(2018, 1, 31)), (1, 5, "K", "T", date(2018, 3, 1))],
    "contract_other": [
        (1, "K", "T", date(2018, 1, 1), date(2018, 1, 31), "D3"),
        (1, "K", "T", date(2018, 1, 5), date(2018, 2, 1), "D2"),
        (2, "K", "T", date(2018, 1, 1), date(2018, 12, 31), "D1"),
    ],
    "resale": [(1, 1, "RL"), (1, 5, "RL")],
    "daily_rate": [(date(2018, 1, 10), "USD", 0.5)],
}


@pytest.fixture(scope="module")
def tables(spark):
    measures = {
        "one": spark.createDataFrame([(1, 1, 10.0)], "grec_seq_rec bigint, rres_seq_reserva bigint, ttv double"),
        "two": spark.createDataFrame([(1, 1, 4.0), (1, 2, 6.0)], "grec_seq_rec bigint, rres_seq_reserva bigint, platform_fee_eur double"),
        "three": spark.createDataFrame(
            [], "grec_seq_rec bigint, rres_seq_reserva bigint, " + ", ".join(f"{name} double" for name in OTHER_MEASURES)
        ),
    }

    def read(name):
        return measures[name] if name in measures else frame(spark, name, ROWS[name])

    return load_header_tables(read, list(measures))


def test_inner_for_operator_and_country_left_for_offices_and_interface(tables):
    rows = header.with_dimensions(
        tables.header, tables.operators, tables.countries, tables.receptives, tables.interfaces
    )
    got = {row["seq_reserva"]: row for row in rows.collect()}
    assert set(got) == {0, 1, 2, 5}
    assert got[2]["source_market"] == "FR" and got[2]["seq_rec_rf"] is None and got[2]["partner_ttoo"] is None
    assert got[1]["source_market_iso"] == "es" and got[1]["des_receptivo_re"] == "Office"


def test_contract_needs_the_date_inside_and_the_office(tables):
    rows = header.contract_destinations(tables.others, tables.contracts, tables.destinations)
    got = sorted((row["seq_reserva"], row["cod_destino"]) for row in rows.collect())
    assert got == [(1, "D3"), (2, "D2"), (2, "D3")]
    first = header.first_contract_destination(tables.others, tables.contracts, tables.destinations)
    assert sorted((row["seq_reserva"], row["cod_destino"]) for row in first.collect()) == [(1, "D3"), (2, "D3")]


def test_shuffled_lookups_give_the_same_destinations(tables):
    def rows(small):
        sides = [Lookup(side.frame, small) for side in (tables.contracts, tables.destinations)]
        return sorted(header.contract_destinations(tables.others, *sides).collect())

    assert rows(True) == rows(False)


def test_wide_extract(tables):
    got = {row["seq_reserva"]: row for row in build_wide_extract(tables, "2018-01-10 00:00:00", "2018-01-10 12:30:00").collect()}
    assert set(got) == {1, 2, 5}
    assert got[1]["Destination_code"] == "D1-Palma"
    assert got[2]["Destination_code"] == "D3-Oslo"
    assert got[5]["Destination_code"] == "NO_DESTINATION_CODE"
    assert (got[1]["Application"], got[1]["first_booking_ts"]) == ("early", datetime(2018, 1, 1))
    assert (got[1]["canrec_status"], got[5]["canrec_status"], got[2]["canrec_status"]) == ("Reventa", "Cancelada", None)
    assert [got[n]["NUMBER_ACTIVE_ACC_SERV"] for n in (1, 2, 5)] == [2, 1, 0]
    assert (got[1]["TTV_booking_currency"], got[1]["TTV_EUR_currency"], got[2]["TTV_booking_currency"]) == (10.0, 5.0, 0.0)
    assert (got[1]["Platform_Fee_EUR"], got[2]["Platform_Fee_EUR"]) == (4.0, 6.0)
    assert (got[1]["holder"], got[1]["modification_date"], got[5]["cancellation_ts"]) == ("ab", "", "2018-01-10 12:30:00")
    assert (got[1]["Accomodation_model"], got[5]["Accomodation_model"]) == ("Merchant", "Pago en hotel")


def test_wide_has_129_distinct_fields():
    assert len(wide_fields()) == 129 and len({name.lower() for name in wide_fields()}) == 129


def test_unknown_currency_day_has_no_rate(spark):
    rates = fixed(frame(spark, "daily_rate", [(date(2018, 1, 10), "USD", 0.5)]))
    rows = spark.createDataFrame([(DAY, "USD"), (DAY, "EUR")], "fec_creacion timestamp_ntz, gdiv_cod_divisa string")
    assert sorted(with_daily_rate(rows, rates).select(F.col("day_rate")).collect(), key=str) == [(0.5,), (None,)]


def test_wide_extract_is_in_published_order(tables):
    assert build_wide_extract(tables, "2018-01-01 00:00:00", "2018-02-01 00:00:00").columns == list(wide.PUBLISHED)
    assert wide.PUBLISHED[5:8] == ("interface_id", "operative_company", "operative_office") and len(wide.PUBLISHED) == 129


def test_header_is_in_published_order(tables):
    columns = header.booking_header(tables.header, tables.operators, tables.countries, tables.receptives, tables.interfaces).columns
    assert columns == [*header.CARRIED, *header.PUBLISHED]
