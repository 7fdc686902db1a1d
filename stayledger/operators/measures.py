"""Per-booking measures: sales tax, cost tax and transfer price, in booking currency and in euros."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.functions.money import EXACT, night_amount
from stayledger.functions.scalars import EUR
from stayledger.operators.exclusions import EXTRA, exclusion_keys, without_excluded
from stayledger.operators.fx import FxRates, exchanged, exchanged_cents, round_to_currency
from stayledger.operators.keys import BOOKING, in_scope
from stayledger.operators.lines import tax_by_booking, with_tax, with_tax_amounts
from stayledger.operators.lookup import Lookup

SALES_TAX = "tax_sales_transfer_pricing"
COST_TAX = "tax_cost_transfer_pricing"
TRANSFER = "transfer_pricing"

# How many lines of a booking had no rate.
UNCONVERTED = "unconverted_lines"

# Measure and the name of its euro value. The euro transfer price is named differently.
EUR_NAMES = {
    SALES_TAX: "tax_sales_transfer_pricing_eur",
    COST_TAX: "tax_cost_transfer_pricing_eur",
    TRANSFER: "tax_transfer_pricing_eur",
}


@dataclass(frozen=True)
class Books:
    """Inputs of the measures. ``lines`` is the tagged union of the service tables."""

    lines: DataFrame
    costs: DataFrame
    extra_bonds: DataFrame
    discount_bonds: Lookup
    campaigns: Lookup
    tax: Lookup
    currencies: Lookup
    fx: FxRates
    tax_type_on_sales_join: bool = True

    def scoped(self, bookings: Lookup, span: tuple[int, int] | None = None) -> Books:
        """Only the lines, costs and bonds of some bookings, selected by key where they are read.

        Few bookings are broadcast; more act through a Bloom filter of their keys (``in_scope``). A ``span`` that is
        known (least and greatest booking number) is pushed into the files as well.
        """

        def reduced(rows: DataFrame, office: str, booking: str) -> DataFrame:
            near = rows.filter(F.col(booking).between(*map(F.lit, span))) if span else rows
            return in_scope(near, bookings, office, booking)

        return replace(
            self,
            lines=reduced(self.lines, "seq_rec", "seq_reserva"),
            costs=reduced(self.costs, "grec_seq_rec", "rres_seq_reserva"),
            extra_bonds=reduced(self.extra_bonds, "grec_seq_rec", "rres_seq_reserva"),
        )

    def exclusions(self) -> DataFrame:
        return exclusion_keys(self.extra_bonds, self.discount_bonds, self.campaigns)


def priced_bookings(bookings: DataFrame, fx: FxRates) -> DataFrame:
    """Bookings with the snapshot of their creation date and the two rates every measure needs."""
    dated = fx.with_snapshot(bookings, F.col("creation_date"))
    dated = fx.with_rate(dated, F.col("booking_currency"), "booking_rate")
    return fx.with_rate(dated, EUR, "eur_rate")


def billable(costs: DataFrame) -> DataFrame:
    """Direct cost lines that can be invoiced."""
    return costs.filter((F.col("ind_tipo_registro") == "DR") & (F.col("ind_facturable") == "S"))


def cost_nights(costs: DataFrame) -> Column:
    names = ("fec_desde", "fec_hasta", "nro_unidades", "nro_pax", "ind_tipo_unid", "ind_p_s", "imp_unitario")
    return night_amount(*(costs[name] for name in names))


def cost_amounts(books: Books) -> DataFrame:
    """Billable cost lines: booking, extra, currency and amount over the nights."""
    lines = billable(books.costs)
    return lines.select(
        F.col("grec_seq_rec").alias("seq_rec"),
        F.col("rres_seq_reserva").alias("seq_reserva"),
        F.col("rext_ord_extra").alias("ord_extra"),
        F.col("sdiv_cod_divisa").alias("cost_currency"),
        cost_nights(lines).alias("nights"),
    )


def included_costs(books: Books) -> DataFrame:
    """Billable cost per (booking, currency), the costs of excluded extras left out."""
    by_extra = (
        cost_amounts(books)
        .groupBy(*EXTRA, "cost_currency")
        .agg(F.sum("nights").alias("nights"), F.count("nights").alias("cost_lines"))
    )
    return (
        without_excluded(by_extra, books.exclusions())
        .groupBy("seq_rec", "seq_reserva", "cost_currency")
        .agg(F.sum("nights").alias("nights"), F.sum("cost_lines").alias("cost_lines"))
    )


def lines_of_bookings(lines: DataFrame, bookings: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Lines with their booking's columns, extras of unprofitable campaigns left out, dealt out by booking once.

    For amounts that are rounded line by line and so cannot be summed before their booking's rate is known. The join
    with the bookings deals the lines out by booking; the exclusions are dealt out the same way, and so is what sums by
    booking afterwards, so the lines do not move again. A hot booking is split in the first join.

    The exclusions, one row per key, mark the lines by an outer join: Spark would put an anti join below the first join,
    where the lines are not dealt out yet.
    """
    marked = lines.join(bookings, ["seq_rec", "seq_reserva"]).join(exclusions.withColumn("_excluded", F.lit(True)), list(EXTRA), "left")
    return marked.where(F.col("_excluded").isNull()).drop("_excluded")


def _cents(amount: Column, from_rate: Column, to_rate: Column) -> Column:
    """An amount converted and rounded by itself; 0 without a rate."""
    return F.coalesce(exchanged_cents(amount, from_rate, to_rate), F.lit(0).cast(EXACT))


def cost_by_booking(books: Books, priced: DataFrame, target: str | None = None) -> DataFrame:
    """Cost per booking in its own currency, or in ``target``, with the count of lines that had no rate.

    All lines of one booking and currency share a rate. Into the booking currency their sum is converted;
    into euros every line is converted and rounded by itself. Bookings without cost lines are absent.
    """
    to_rate = F.col("booking_rate") if target is None else F.col("eur_rate")
    if target not in (None, EUR):
        raise ValueError(f"costs convert to the booking currency or to {EUR}, not to {target}")
    bookings = priced.select(
        F.col(BOOKING[0]).alias("seq_rec"), F.col(BOOKING[1]).alias("seq_reserva"), "snapshot_date", to_rate.alias("to_rate")
    )
    if target is None:
        costs, lines = included_costs(books).join(bookings, ["seq_rec", "seq_reserva"]), F.col("cost_lines")
        converted = F.coalesce(F.sum(exchanged(F.col("nights"), F.col("from_rate"), F.col("to_rate"))), F.lit(0.0))
    else:
        costs = lines_of_bookings(cost_amounts(books), bookings, books.exclusions())
        lines = F.col("nights").isNotNull().cast("bigint")
        converted = F.sum(_cents(F.col("nights"), F.col("from_rate"), F.col("to_rate"))).cast("double")
    joined = books.fx.with_rate(costs, F.col("cost_currency"), "from_rate")
    no_rate = F.col("from_rate").isNull() | F.col("to_rate").isNull()
    return joined.groupBy("seq_rec", "seq_reserva").agg(
        converted.alias("cost_field"),
        F.sum(F.when(no_rate, lines).otherwise(F.lit(0))).alias(UNCONVERTED),
    )


def transfer_tax(sales: Column, cost: Column, booking_rate: Column, eur_rate: Column) -> Column:
    """Sales tax in booking currency plus cost tax in euros; the sum mixes the two on purpose.

    A cost tax without a rate counts as 0.
    """
    return sales + F.coalesce(exchanged(cost, booking_rate, eur_rate), F.lit(0.0))


def booking_taxes(books: Books) -> DataFrame:
    return tax_by_booking(books.lines, books.tax, books.exclusions(), books.tax_type_on_sales_join)


def transfer_price_by_booking(books: Books, priced: DataFrame) -> DataFrame:
    """Transfer-price tax per booking that has service lines, before costs and rounding."""
    bookings = priced.select(
        F.col(BOOKING[0]).alias("seq_rec"), F.col(BOOKING[1]).alias("seq_reserva"), "booking_rate", "eur_rate"
    )
    return (
        booking_taxes(books)
        .join(bookings, ["seq_rec", "seq_reserva"])
        .select(
            "seq_rec",
            "seq_reserva",
            transfer_tax(F.col("sales_tax"), F.col("cost_tax"), F.col("booking_rate"), F.col("eur_rate")).alias(
                "impuesto_canco"
            ),
        )
    )


def null_safe_total(fields: DataFrame, left: str, right: str, out: str, fill_each: bool = True) -> DataFrame:
    """Sum of two optional amounts.

    Filling each side keeps a booking that has only one of them. Filling the sum
    instead (``fill_each=False``) loses it.
    """
    zero = F.lit(0.0)
    if fill_each:
        total = F.coalesce(F.col(left), zero) + F.coalesce(F.col(right), zero)
    else:
        total = F.coalesce(F.col(left) + F.col(right), zero)
    return fields.withColumn(out, total)


def with_measures(
    books: Books, bookings: DataFrame, measures: tuple[str, ...] = tuple(EUR_NAMES), count_unconverted: bool = False
) -> DataFrame:
    """Bookings with the chosen measures and their euro values; every booking is kept.

    One pass over the service lines and one over the cost lines serve all three
    measures. What is not asked for is pruned. ``count_unconverted`` adds how many cost lines of the booking had no
    rate and so count as 0.
    """
    keys = [F.col("seq_rec").alias(BOOKING[0]), F.col("seq_reserva").alias(BOOKING[1])]
    priced = priced_bookings(bookings, books.fx)
    joined = priced.join(booking_taxes(books).select(*keys, "sales_tax", "cost_tax"), list(BOOKING), "left")
    if set(measures) & {COST_TAX, TRANSFER}:
        costs = cost_by_booking(books, priced).select(*keys, "cost_field", UNCONVERTED)
        joined = joined.join(costs, list(BOOKING), "left")
    else:
        joined = joined.withColumns({"cost_field": F.lit(0.0), UNCONVERTED: F.lit(0).cast("bigint")})
    transfer = transfer_tax(F.col("sales_tax"), F.col("cost_tax"), F.col("booking_rate"), F.col("eur_rate"))
    joined = joined.withColumn("_transfer_tax", transfer)
    joined = joined.withColumn(SALES_TAX, F.coalesce("sales_tax", F.lit(0.0)))
    joined = null_safe_total(joined, "cost_tax", "cost_field", COST_TAX)
    joined = null_safe_total(joined, "_transfer_tax", "cost_field", TRANSFER)
    rounded = round_to_currency(joined, list(measures), "booking_currency", books.currencies)
    with_eur = rounded.withColumns(
        {
            EUR_NAMES[name]: F.coalesce(
                exchanged_cents(F.col(name), F.col("booking_rate"), F.col("eur_rate")), F.lit(0).cast(EXACT)
            )
            for name in measures
        }
    )
    counted = [F.coalesce(UNCONVERTED, F.lit(0)).alias(UNCONVERTED)] if count_unconverted else []
    return with_eur.select(*bookings.columns, *(column for name in measures for column in (name, EUR_NAMES[name])), *counted)


def taxes_eur_by_booking(books: Books, priced: DataFrame) -> DataFrame:
    """Sales and cost tax per booking in euros, every line converted and rounded by itself."""
    bookings = priced.select(
        F.col(BOOKING[0]).alias("seq_rec"), F.col(BOOKING[1]).alias("seq_reserva"), "booking_rate", "eur_rate"
    )
    amounts = with_tax_amounts(with_tax(books.lines, books.tax, books.tax_type_on_sales_join)).select(*EXTRA, "sales_tax", "cost_tax")
    rates = (F.col("booking_rate"), F.col("eur_rate"))
    return (
        lines_of_bookings(amounts, bookings, books.exclusions())
        .groupBy("seq_rec", "seq_reserva")
        .agg(*(F.sum(_cents(F.col(name), *rates)).cast("double").alias(f"{name}_eur") for name in ("sales_tax", "cost_tax")))
    )


def line_level_eur(books: Books, bookings: DataFrame, measure: str) -> DataFrame:
    """Euro value of a measure from line amounts, each converted and rounded, instead of from the booking total.

    Costs convert from their own currency straight to euros.
    """
    keys = [F.col("seq_rec").alias(BOOKING[0]), F.col("seq_reserva").alias(BOOKING[1])]
    priced = priced_bookings(bookings, books.fx)
    parts = [taxes_eur_by_booking(books, priced).select(*keys, "sales_tax_eur", "cost_tax_eur")]
    names = {SALES_TAX: ["sales_tax_eur"], COST_TAX: ["cost_tax_eur"], TRANSFER: ["sales_tax_eur", "cost_tax_eur"]}[measure]
    if measure != SALES_TAX:
        parts.append(cost_by_booking(books, priced, EUR).select(*keys, "cost_field"))
        names.append("cost_field")
    joined = reduce(lambda left, right: left.join(right, list(BOOKING), "left"), parts, bookings)
    total = reduce(lambda a, b: a + b, (F.coalesce(name, F.lit(0.0)) for name in names))
    return joined.select(*bookings.columns, total.alias(EUR_NAMES[measure]))
