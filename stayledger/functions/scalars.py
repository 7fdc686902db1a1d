"""Small value rules: decoding, text, dates, status flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange-rate type codes. Two uses share the code R.
RATE_TYPES = {
    "EXCHANGE_M": "M",
    "EXCHANGE_EXC": "R",
    "EXCHANGE_RES": "R",
    "EXCHANGE_LIQ": "L",
    "EXCHANGE_CAJ": "C",
    "EXCHANGE_CTB": "A",
}

EUR = "EUR"
NO_DESTINATION = "NO_DESTINATION_CODE"


def decode(value: Column, search: Column, result: Column, default: Column) -> Column:
    """Two-way decode; a null search matches a null value."""
    return F.when(value.eqNullSafe(search), result).otherwise(default)


def nvl(*values: Column) -> Column:
    return F.coalesce(*values)


def strip_semicolons(text: Column) -> Column:
    """Names travel in semicolon-separated files."""
    return F.replace(text, F.lit(";"), F.lit(""))


def midnight(value: Column) -> Column:
    """Date, timestamp or ``yyyy-MM-dd`` text to that day's midnight; empty text to null."""
    return value.try_cast("date").cast("timestamp_ntz")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def latest(*moments: Column) -> Column:
    """Latest of several moments, ignoring the missing ones."""
    return F.greatest(*moments)


def interface_id(office: Column, booking: Column) -> Column:
    """``office-booking``; null when either part is null."""
    return F.concat(office.cast("string"), F.lit("-"), booking.cast("string"))


def is_set(value: Column) -> Column:
    """'S' when the value is present, 'N' when it is null."""
    return F.when(value.isNull(), F.lit("N")).otherwise(F.lit("S"))


def accommodation_model(payment_type: Column) -> Column:
    return F.when(payment_type.isNull(), F.lit("Merchant")).otherwise(F.lit("Pago en hotel"))


def resale_status(status: Column, cancelled_at: Column) -> Column:
    """Readable recovery status of a booking offered for resale.

    A released booking counts as resold until it is cancelled; codes outside the
    list have no reading.
    """
    code = (
        F.when(status == "RR", F.lit("R"))
        .when(status == "CN", F.lit("RL"))
        .when(status == "RL", F.when(cancelled_at.isNull(), F.lit("RS")).otherwise(F.lit("C")))
        .otherwise(status)
    )
    return (
        F.when(code.isin("RS", "R"), F.lit("Reventa"))
        .when(code == "C", F.lit("Cancelada"))
        .when(code == "RL", F.lit("Liberada"))
    )


def exchange_date(rule: Column, service_start: Column, created: Column) -> Column:
    """Day whose rate applies: service start under rule 'E', creation otherwise."""
    return F.when(rule == "E", service_start).otherwise(created)


def regime_code(regime: Column, transfer_price: Column) -> Column:
    """Regime followed by the transfer-price flag, a missing flag read as 'N'."""
    return F.concat(regime, F.coalesce(transfer_price, F.lit("N")))


def destination_code(
    hotel_code: Column, hotel_name: Column, contract_code: Column, contract_name: Column
) -> Column:
    """``code-name`` of the hotel, else of the contract, else a fixed marker."""
    return F.coalesce(
        F.concat(hotel_code, F.lit("-"), hotel_name),
        F.concat(contract_code, F.lit("-"), contract_name),
        F.lit(NO_DESTINATION),
    )


def times_rate(amount: Column, rate: Column) -> Column:
    """Amount times an optional rate; either one missing counts as 0."""
    return F.coalesce(amount, F.lit(0.0)) * F.coalesce(rate, F.lit(0.0))
