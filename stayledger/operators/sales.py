"""Sale lines: total transaction value and its tax."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.money import night_amount
from stayledger.functions.scalars import exchange_date, regime_code
from stayledger.operators.lookup import Lookup
from stayledger.sources.store import StoredLines

# Record types left out of each measure, and the two tax regimes.
NOT_TTV = ("O", "V", "D", "W", "Y", "IT")
NOT_TAX = ("O", "D", "IT")
GENERAL = "GN"
TOMS = "EN"

SALE_TAX_KEY = (
    ("rvp_ind_tipo_imp", "ind_tipo_imp"),
    ("rvp_cod_impuesto", "cod_impuesto"),
    ("rvp_cod_esquema", "cod_esquema"),
    ("rvp_cod_clasif", "cod_clasif"),
    ("rvp_cod_empresa", "cod_emp_atlas"),
)


def countable(sales: DataFrame, left_out: tuple[str, ...]) -> DataFrame:
    """Sale lines of the record types that count, reversing entries left out."""
    return sales.filter(~F.col("ind_tipo_registro").isin(*left_out) & (F.col("ind_contra_apunte") == "N"))


def merchant_line() -> Column:
    return F.col("ind_facturable") == "S"


def hotel_payment_line() -> Column:
    return F.col("ind_tipo_registro") != "CH"


def charged(payment_type: Column) -> Column:
    """Lines a booking is charged for: the invoiced ones if the wholesaler collects
    (no payment type), all but the 'CH' ones if the hotel does."""
    return (payment_type.isNull() & merchant_line()) | (payment_type.isNotNull() & hotel_payment_line())


def sale_nights(unit_amount: Column) -> Column:
    return night_amount(
        F.col("fec_desde_s"),
        F.col("fec_hasta_s"),
        F.col("nro_unidades"),
        F.col("nro_pax"),
        F.col("ind_tipo_unid"),
        F.col("ind_p_s"),
        unit_amount,
    )


def sum_by_payment(lines: DataFrame, amounts: dict[str, Column], bookings: DataFrame) -> DataFrame:
    """Sum line amounts per booking over the lines its payment type charges; 0 without lines.

    Which lines count depends on the booking, so both readings are summed by
    booking first and the booking picks one. The lines themselves are never
    joined, and a booking with very many lines is reduced before the shuffle.
    """
    sums = [
        F.sum(F.when(rule, amount)).alias(f"_{name}_{model}")
        for name, amount in amounts.items()
        for model, rule in (("merchant", merchant_line()), ("hotel", hotel_payment_line()))
    ]
    by_booking = lines.groupBy(
        F.col("grec_seq_rec_s").alias("grec_seq_rec"), F.col("rres_seq_reserva").alias("seq_reserva")
    ).agg(*sums)
    joined = bookings.join(by_booking, ["grec_seq_rec", "seq_reserva"], "left")
    picked = {
        name: F.coalesce(
            F.when(F.col("ind_tippag").isNull(), F.col(f"_{name}_merchant")).otherwise(F.col(f"_{name}_hotel")),
            F.lit(0.0),
        )
        for name in amounts
    }
    return joined.select(*bookings.columns, *(column.alias(name) for name, column in picked.items()))


def ttv_by_booking(sales: DataFrame, bookings: DataFrame) -> DataFrame:
    """Total transaction value in booking currency.

    Source and target currency are the same, and an amount in its own currency
    is not converted.
    """
    lines = countable(sales, NOT_TTV)
    return sum_by_payment(lines, {"TTV_booking_currency": sale_nights(F.col("imp_unitario"))}, bookings)


def lines_with_booking(lines: DataFrame | StoredLines, bookings: Lookup, key: list[str]) -> DataFrame:
    """Lines with their booking's columns: by the layout of a store where the lines have one, else by a join that may move them."""
    return bookings.join(lines, key) if isinstance(lines, DataFrame) else lines.join(bookings.frame)


def with_sale_tax(sales: DataFrame, tax: Lookup) -> DataFrame:
    """Add ``line_tax`` and ``regime``: the stated tax, else the night amount of the tax in the unit price.

    Zero for record type 'BT'.
    """
    divisor = F.lit(1.0) + F.col("pct_impuesto") / F.lit(100.0)
    divisors = tax.select(*(F.col(table).alias(line) for line, table in SALE_TAX_KEY), divisor.alias("tax_divisor"))
    taxed = divisors.join(countable(sales, NOT_TAX), [line for line, _ in SALE_TAX_KEY], "left")
    unit = F.col("imp_unitario")
    unit_tax = unit - F.try_divide(unit, F.col("tax_divisor"))
    stated = F.coalesce(F.col("imp_impuesto"), sale_nights(unit_tax))
    return taxed.withColumns(
        {
            "line_tax": F.when(F.col("ind_tipo_registro") == "BT", F.lit(0.0)).otherwise(stated),
            "regime": regime_code(F.col("ind_tipo_regimen"), F.col("ind_trfprc")),
        }
    )


def tax_of_regime(regime: str) -> Column:
    return F.when(F.col("regime") == regime, F.col("line_tax")).otherwise(F.lit(0.0))


def charged_lines(sales: DataFrame | StoredLines, payment: Lookup) -> DataFrame:
    """Sale lines that their booking is charged for; ``payment`` has the lines' key columns and the payment type."""
    joined = lines_with_booking(sales, payment, ["grec_seq_rec_s", "rres_seq_reserva"])
    return joined.filter(charged(F.col("ind_tippag")))


def sale_tax_lines(sales: DataFrame | StoredLines, tax: Lookup, bookings: Lookup, regime: str) -> DataFrame:
    """Tax of every charged sale line under one regime, with the date its rate would be taken from.

    Every booking is kept; one without charged lines has one row that names only its key.
    """
    fields = bookings.select(
        F.col("grec_seq_rec").alias("grec_seq_rec_s"),
        F.col("seq_reserva").alias("rres_seq_reserva"),
        "ind_tippag",
        exchange_date(F.col("ind_fec_cam_div"), F.col("fec_desde"), F.col("fec_creacion")).alias("date_ccy_exchange"),
    )
    taxed = with_sale_tax(sales, tax) if isinstance(sales, DataFrame) else sales.of(with_sale_tax(sales.frame, tax))
    lines = lines_with_booking(taxed, fields, ["grec_seq_rec_s", "rres_seq_reserva"])
    taxed = lines.filter(charged(F.col("ind_tippag"))).withColumn("tax_aux", tax_of_regime(regime))
    # An anti join with the keys keeps the join of the lines inner, which a hot booking can be split in.
    key = ["grec_seq_rec_s", "rres_seq_reserva"]
    rest = fields.frame.select(*key).join(taxed.select(*key).distinct(), key, "left_anti")
    return taxed.unionByName(rest, allowMissingColumns=True)


def tax_ttv(sales: DataFrame, tax: Lookup, bookings: DataFrame, regimes: dict[str, str] | None = None) -> DataFrame:
    """Sale tax per booking, one output column per regime, all in one pass."""
    regimes = regimes or {"Tax_TTV": GENERAL, "Tax_TTV_TOMS": TOMS}
    lines = with_sale_tax(sales, tax)
    return sum_by_payment(lines, {name: tax_of_regime(regime) for name, regime in regimes.items()}, bookings)
