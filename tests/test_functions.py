"""Scalar rules on literal values."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayledger.functions import money, scalars

NOW = datetime(2018, 3, 4, 15, 30)
LATER = NOW + timedelta(days=5)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def literal(x, kind):
    return F.lit(x).cast(kind)


@pytest.mark.parametrize(
    "given, expected", [((1, 1, 3, 4), 3), ((1, 2, 3, 4), 4), ((None, None, 3, 4), 3), ((None, 2, 3, 4), 4)]
)
def test_decode(spark, given, expected):
    assert value(spark, scalars.decode(*(literal(x, "int") for x in given))) == expected


@pytest.mark.parametrize(
    "start, end, units, pax, unit_type, per, unit_amount, days, expected",
    [
        (None, None, 0, 0, "0", "0", 0, 0, 0),
        (NOW, LATER, 2, 0, "0", "0", 100, 10, 2000),
        (NOW, LATER, 2, 3, "0", "P", 100, 10, 3000),
        (NOW, LATER, 2, 3, "N", "P", 100, 0, 1500),
        (NOW, LATER, 2, 3, "S", "P", 100, 0, 1800),
        (NOW, None, 2, 3, "S", "P", 100, 0, 0),
        (NOW, LATER, 2, 3, None, None, 100, None, 200),
        (NOW, LATER, 2, 3, "D", "S", 100, None, 200),
        (NOW, LATER, 2, 3, "N", "S", None, None, None),
        (datetime(2018, 1, 1, 23, 59), datetime(2018, 1, 2, 0, 1), 1, 1, "N", "S", 7, None, 7),
    ],
)
def test_night_amount(spark, start, end, units, pax, unit_type, per, unit_amount, days, expected):
    amount = money.night_amount(
        literal(start, "timestamp_ntz"),
        literal(end, "timestamp_ntz"),
        literal(units, "int"),
        literal(pax, "int"),
        literal(unit_type, "string"),
        literal(per, "string"),
        literal(unit_amount, "decimal(15,3)"),
        literal(days, "int"),
    )
    assert value(spark, amount) == expected


def test_embedded_tax(spark):
    assert value(spark, money.embedded_tax(F.lit(100.0), F.lit(25.0))) == pytest.approx(20.0)
    assert value(spark, money.embedded_tax(F.lit(100.0), F.lit(0.0))) == 0
    assert value(spark, money.embedded_tax(F.lit(100.0), F.lit(-100.0))) is None
    assert value(spark, money.embedded_tax(literal(None, "double"), F.lit(25.0))) is None


@pytest.mark.parametrize(
    "amount, decimals, expected",
    [(1.005, 2, "1.01"), (2.675, 2, "2.68"), (-0.5, 0, "-1"), (0.5, 0, "1"), (1.5, 0, "2"), (2.5, 0, "3"), (1.0005, 3, "1.001")],
)
def test_round_half_up_at_ties(spark, amount, decimals, expected):
    assert value(spark, money.round_half_up(F.lit(amount), decimals)) == Decimal(expected)


def test_round_by_decimals_leaves_unknown_alone(spark):
    amount = F.lit(12.34567)
    assert value(spark, money.round_by_decimals(amount, F.lit(0))) == Decimal("12")
    assert value(spark, money.round_by_decimals(amount, F.lit(3))) == Decimal("12.346")
    assert value(spark, money.round_by_decimals(amount, literal(None, "int"))) == Decimal("12.34567")


@pytest.mark.parametrize(
    "text, expected", [("2018-01-05", datetime(2018, 1, 5)), ("", None), (None, None), ("not a day", None)]
)
def test_midnight_of_text(spark, text, expected):
    assert value(spark, scalars.midnight(literal(text, "string"))) == expected


def test_midnight_of_date_and_timestamp(spark):
    assert value(spark, scalars.midnight(F.to_date(F.lit("2018-01-05")))) == datetime(2018, 1, 5)
    assert value(spark, scalars.midnight(literal(NOW, "timestamp_ntz"))) == datetime(2018, 3, 4)


@pytest.mark.parametrize(
    "status, cancelled, expected",
    [
        ("RR", None, "Reventa"),
        ("CN", None, "Liberada"),
        ("RL", None, "Reventa"),
        ("RL", NOW, "Cancelada"),
        ("R", None, "Reventa"),
        ("ZZ", None, None),
        (None, None, None),
    ],
)
def test_resale_status(spark, status, cancelled, expected):
    column = scalars.resale_status(literal(status, "string"), literal(cancelled, "timestamp_ntz"))
    assert value(spark, column) == expected


def test_text_rules(spark):
    assert value(spark, scalars.strip_semicolons(F.lit("a;b;;c"))) == "abc"
    assert value(spark, scalars.interface_id(F.lit(12), F.lit(34))) == "12-34"
    assert value(spark, scalars.interface_id(F.lit(12), literal(None, "bigint"))) is None
    assert value(spark, scalars.regime_code(F.lit("G"), literal(None, "string"))) == "GN"
    assert value(spark, scalars.regime_code(literal(None, "string"), F.lit("N"))) is None
    none = literal(None, "string")
    assert value(spark, scalars.destination_code(none, F.lit("x"), F.lit("P"), F.lit("Palma"))) == "P-Palma"
    assert value(spark, scalars.destination_code(none, none, none, none)) == "NO_DESTINATION_CODE"


def test_dates_and_flags(spark):
    none = literal(None, "timestamp_ntz")
    now = literal(NOW, "timestamp_ntz")
    later = literal(LATER, "timestamp_ntz")
    assert value(spark, scalars.latest(now, none, later)) == LATER
    assert value(spark, scalars.exchange_date(F.lit("E"), later, now)) == LATER
    assert value(spark, scalars.exchange_date(literal(None, "string"), later, now)) == NOW
    assert value(spark, scalars.is_set(none)) == "N"
    assert value(spark, scalars.second_text(now)) == "2018-03-04 15:30:00"
    assert value(spark, scalars.times_rate(literal(None, "double"), F.lit(2.0))) == 0


def test_rate_type_codes():
    assert scalars.RATE_TYPES["EXCHANGE_EXC"] == scalars.RATE_TYPES["EXCHANGE_RES"] == "R"


def test_rounding_by_any_number_of_decimals(spark):
    rows = [(1234.567895, d) for d in (-5, -3, -2, -1, 0, 2, 4, 5, 6, 9, None)] + [(-1250.0, -2), (1250.0, -2), (1.0, -40)]
    table = spark.createDataFrame(rows, "amount double, decimals int")
    got = [float(row[0]) for row in table.select(money.round_by_decimals(F.col("amount"), F.col("decimals"))).collect()]
    assert got == [0, 1000, 1200, 1230, 1235, 1234.57, 1234.5679, 1234.5679, 1234.567895, 1234.567895, 1234.567895, -1300, 1300, 0]
