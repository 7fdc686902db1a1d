"""Conversion against a bisect over the snapshot days, with the lookups broadcast and shuffled."""

import random
from bisect import bisect_right
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayledger.operators import fx
from stayledger.operators.fx import FxRates, rates_from_mapping
from stayledger.operators.lookup import Lookup
from tests.frames import FX_MAPPING, frame

DAYS = sorted({day for content in FX_MAPPING.values() for day in content["EXCHANGE_RATES"]})


def brute(source, target, day, amount, kind="M"):
    position = bisect_right(DAYS, day)
    if position == 0 or amount is None:
        return None
    rates = FX_MAPPING[kind]["EXCHANGE_RATES"].get(DAYS[position - 1], {})
    if source not in rates or target not in rates:
        return None
    return amount * rates[source] / rates[target]


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def rates(request, spark):
    return FxRates(Lookup(rates_from_mapping(spark, FX_MAPPING), request.param))


def test_convert_matches_bisect(spark, rates):
    pick = random.Random(7)
    codes = ["EUR", "USD", "GBP", "JPY", "KWD", "XXX", None]
    rows = [
        (n, pick.choice(codes), pick.choice(codes[:5]), date(1994, 12, 1) + timedelta(days=pick.randrange(2600)), pick.choice([None, 100.0, 12.5]))
        for n in range(400)
    ]
    table = spark.createDataFrame(rows, "n int, source string, target string, day date, amount double")
    for kind in ("M", "R"):
        out = rates.convert(table, F.col("amount"), F.col("source"), F.col("target"), F.col("day"), "out", kind)
        got = {row["n"]: row["out"] for row in out.collect()}
        assert got == {n: brute(s, t, d, a, kind) for n, s, t, d, a in rows}


@pytest.mark.parametrize(
    "source, target, day, expected",
    [
        ("USD", "EUR", datetime(1996, 5, 1, 23, 59), 78.0),
        ("USD", "EUR", datetime(1995, 1, 15), None),
        ("GBP", "USD", datetime(1999, 1, 1), 100 * 1.42 / 0.85),
        ("KWD", "EUR", datetime(1997, 7, 1), None),
        ("USD", "EUR", datetime(2018, 1, 1), 105.0),
        ("USD", "EUR", None, None),
    ],
)
def test_literal_target(spark, rates, source, target, day, expected):
    table = spark.createDataFrame([(source, day)], "source string, at timestamp_ntz")
    out = rates.convert(table, F.lit(100.0), F.col("source"), target, F.col("at"), "out")
    assert out.first()["out"] == expected


def test_one_row_in_one_row_out(spark, rates):
    table = spark.range(50).select(F.lit("USD").alias("source"), F.lit(date(1996, 1, 1)).alias("day"))
    assert rates.with_rate(rates.with_snapshot(table, F.col("day")), F.col("source"), "r").count() == 50


def test_round3_is_null_without_a_rate(spark):
    row = spark.range(1).select(
        fx.exchanged_cents(F.lit(1.0005), F.lit(1.0), F.lit(1.0)).alias("a"),
        fx.exchanged_cents(F.lit(1.0), F.lit(None).cast("double"), F.lit(1.0)).alias("b"),
        fx.exchanged(F.lit(1.0), F.lit(1.0), F.lit(0.0)).alias("c"),
    ).first()
    assert (float(row["a"]), row["b"], row["c"]) == (1.001, None, None)


@pytest.mark.parametrize("small", [True, False])
def test_round_to_currency(spark, small):
    currencies = Lookup(frame(spark, "currency", [("EUR", 2), ("JPY", 0), ("KWD", 3)]), small)
    table = spark.createDataFrame([("EUR", 1.005), ("JPY", 2.5), ("KWD", 1.23456), ("ZZZ", 1.23456), (None, 1.5)], "ccy string, a double")
    got = {row["ccy"]: float(row["a"]) for row in fx.round_to_currency(table, ["a"], "ccy", currencies).collect()}
    assert got == {"EUR": 1.01, "JPY": 3.0, "KWD": 1.235, "ZZZ": 1.23456, None: 1.5}


@pytest.mark.parametrize("small", [True, False])
def test_partner_rate_matches_brute_force(spark, small):
    pick = random.Random(3)
    quotes = {}
    for partner in range(4):
        for source, target in (("USD", "EUR"), ("EUR", "USD"), ("GBP", "USD")):
            for _ in range(3):
                quotes[(partner, date(2000, 1, 1) + timedelta(days=pick.randrange(40)), source, target)] = round(pick.uniform(0.5, 2), 3)
    table = spark.createDataFrame(
        [(p, d, s, t, r) for (p, d, s, t), r in quotes.items()],
        "seq_ttoo bigint, fec_desde date, cod_divisa_ori string, cod_divisa_des string, nro_tasa double",
    )
    asked = [
        (n, pick.randrange(5), pick.choice(["USD", "EUR", "GBP"]), pick.choice(["USD", "EUR"]), date(1999, 12, 25) + timedelta(days=pick.randrange(60)))
        for n in range(200)
    ]

    def expected(partner, source, target, day):
        if source == target:
            return 1.0
        found = [
            (d, (s, t) == (source, target), r if (s, t) == (source, target) else 1 / r)
            for (p, d, s, t), r in quotes.items()
            if p == partner and d <= day and {s, t} == {source, target}
        ]
        return max(found)[2] if found else None

    rows = spark.createDataFrame(asked, "n int, partner bigint, source string, target string, day date")
    got = fx.partner_rate(rows, Lookup(table, small), "partner", "source", "target", "day", "rate")
    assert {r["n"]: r["rate"] for r in got.collect()} == {n: expected(p, s, t, d) for n, p, s, t, d in asked}


@pytest.mark.parametrize("small", [True, False])
def test_company_rate_type(spark, small):
    settings = spark.createDataFrame(
        [("E1", date(2000, 1, 1), "r0", "c0", "l0", "a0"), ("E1", date(2001, 1, 1), "r1", "c1", "l1", "a1")],
        "semp_cod_emp string, fec_aplicacion date, tipo_cambio_rex string, tipo_cambio_caj string, tipo_cambio_liq string, tipo_cambio_ctb string",
    )
    rows = [
        (0, "E1", date(1999, 5, 5), "R", "r0"),
        (1, "E1", date(2000, 1, 1), "C", "c0"),
        (2, "E1", date(2000, 1, 2), "L", "l1"),
        (3, "E1", date(2001, 1, 2), "A", "ERROR"),
        (4, "E1", date(1999, 1, 1), "M", "ERROR"),
        (5, "E2", date(1999, 1, 1), "R", "ERROR"),
    ]
    table = spark.createDataFrame([row[:4] for row in rows], "n int, company string, day date, purpose string")
    got = fx.company_rate_type(table, Lookup(settings, small), "company", "day", "purpose", "code")
    assert {row["n"]: row["code"] for row in got.collect()} == {row[0]: row[4] for row in rows}


def test_spread(spark):
    spreads = spark.createDataFrame(
        [("M", "USD", "EUR", date(2000, 1, 1), 1.0, 2.0, 3.0), ("M", "USD", "EUR", date(2001, 1, 1), 10.0, 20.0, 30.0), ("R", "USD", "EUR", date(2001, 1, 1), 50.0, 50.0, 50.0)],
        "tipo_cambio string, cod_divisa_orien string, cod_divisa_destino string, fec_aplicacion date, pct_venta double, pct_compra double, pct_fixing double",
    )
    rows = [
        (0, "USD", "EUR", date(2000, 5, 1), "V", 101.0),
        (1, "USD", "EUR", date(2001, 5, 1), "C", 120.0),
        (2, "USD", "EUR", date(2001, 5, 1), "F", 130.0),
        (3, "USD", "EUR", date(1999, 5, 1), "V", 100.0),
        (4, "USD", "EUR", date(2001, 5, 1), "Z", 100.0),
        (5, "GBP", "EUR", date(2001, 5, 1), "V", 100.0),
    ]
    table = spark.createDataFrame([(*row[:5], 100.0) for row in rows], "n int, s string, t string, day date, kind string, amount double")
    got = fx.with_spread(table, Lookup(spreads, True), "M", "s", "t", "day", "kind", "amount", "out")
    assert {row["n"]: row["out"] for row in got.collect()} == pytest.approx({row[0]: row[5] for row in rows})
