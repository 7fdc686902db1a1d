"""Small hand-written inputs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from stayledger.operators.fx import FxRates
from stayledger.operators.lines import SERVICES, service_lines
from stayledger.operators.lookup import Lookup
from stayledger.operators.measures import Books
from stayledger.sources.schemas import SCHEMAS

FX_MAPPING = {
    "M": {
        "EXCHANGE_RATES": {
            date(1995, 3, 1): {"EUR": 1.0, "USD": 0.76, "GBP": 1.20, "JPY": 0.0080, "KWD": 2.55},
            date(1996, 1, 1): {"EUR": 1.0, "USD": 0.78, "GBP": 1.22, "JPY": 0.0075, "KWD": 2.60},
            date(1997, 6, 15): {"EUR": 1.0, "USD": 0.88, "GBP": 1.45, "JPY": 0.0077},
            date(1999, 1, 1): {"EUR": 1.0, "USD": 0.85, "GBP": 1.42, "JPY": 0.0075, "KWD": 2.80},
            date(2000, 7, 1): {"EUR": 1.0, "USD": 1.05, "GBP": 1.58, "JPY": 0.0098, "KWD": 3.45},
        }
    },
    "R": {
        "EXCHANGE_RATES": {
            date(1996, 1, 1): {"EUR": 1.0, "USD": 0.79},
            date(1999, 1, 1): {"EUR": 1.0, "USD": 0.86},
        }
    },
}


def frame(spark: SparkSession, name: str, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMAS[name])


def line(rec, res, code="8", kind="I", fac="G", con="G", venta=100.0, coste=80.0, canal=10.0, canco=5.0, extra=None):
    head = (rec, res) if extra is None else (rec, res, extra)
    return (*head, fac, con, venta, coste, canal, canco, kind, code, "C", "S", "E")


def cost(rec, res, amount=10.0, ccy="EUR", extra=None, kind="DR", billable="S", nights=2, units=1):
    start = datetime(1996, 7, 1)
    return (rec, res, extra, ccy, start, datetime(1996, 7, 1 + nights), units, 1, "N", "S", amount, kind, billable)


def booking(rec, res, ccy="EUR", created=date(1996, 5, 1), cancelled=""):
    return (rec, res, "E1", created, ccy, "", cancelled, created, created, created)


TAX = [("I", "0", "C", "S", "E", 0.0), ("I", "8", "C", "S", "E", 25.0), ("I", "9", "C", "S", "E", -100.0)]


def books(
    spark: SparkSession,
    services: dict | None = None,
    costs: list = (),
    extra_bonds: list = (),
    discount_bonds: list = (),
    campaigns: list = (),
    tax: list = tuple(TAX),
    small: bool = True,
    **changes,
) -> Books:
    from stayledger.operators.fx import rates_from_mapping

    services = services or {}
    tables = {name: frame(spark, name, services.get(name, [])) for name in SERVICES}
    return Books(
        lines=service_lines(tables),
        costs=frame(spark, "cost", list(costs)),
        extra_bonds=frame(spark, "extra_bond", list(extra_bonds)),
        discount_bonds=Lookup(frame(spark, "discount_bond", list(discount_bonds)), small),
        campaigns=Lookup(frame(spark, "campaign", list(campaigns)), small),
        tax=Lookup(frame(spark, "tax", list(tax)), small),
        currencies=Lookup(frame(spark, "currency", [("EUR", 2), ("USD", 2), ("JPY", 0)]), small),
        fx=FxRates(Lookup(rates_from_mapping(spark, FX_MAPPING), small)),
        **changes,
    )


def book_rows() -> tuple[dict, list]:
    """Services and costs of 20 bookings, one of which owns most rows."""
    numbers = [n % 20 if n % 3 else 1 for n in range(120)]
    services = {
        "hotel": [line(1, n, venta=100.0 + i) for i, n in enumerate(numbers)],
        "extra": [line(1, n, extra=i % 4) for i, n in enumerate(numbers)],
    }
    return services, [cost(1, n, amount=1.0 + i, ccy=("EUR", "USD", "GBP")[i % 3], extra=i % 4) for i, n in enumerate(numbers)]
