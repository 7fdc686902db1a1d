"""One query per operator and measure, over whole tables.

Computed amounts leave as doubles rounded to 4 decimals, converted totals to
cents or to their currency, so that the order in which a sum was added up cannot
show.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.money import embedded_tax, regime_amount, round_half_up
from stayledger.functions.money import night_amount as amount_of_nights
from stayledger.functions.scalars import (
    EUR,
    accommodation_model,
    day_text,
    decode,
    exchange_date,
    interface_id,
    is_set,
    latest,
    nvl,
    resale_status,
    second_text,
    strip_semicolons,
)
from stayledger.operators import asof, contract, exclusions, fx, header, keys, lines, measures, sales
from stayledger.operators.lookup import Lookup, measured
from stayledger.plans.extract import assemble, base_bookings, build_extract, with_midnights, without_measures
from stayledger.plans.sql_measures import SqlMeasures
from stayledger.plans.wide import build_wide_extract, with_daily_rate
from workload.roles import Roles

RUN_DATE = date(1996, 5, 2)
RANGE = ("1996-01-01 00:00:00", "1999-12-31 23:59:59")
WIDE_RANGE = ("1995-01-01 00:00:00", "2001-12-31 23:59:59")
TOP = 100

REGISTRY: dict[str, Callable[[Roles], DataFrame]] = {}


def query(function: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    REGISTRY[function.__name__.removesuffix("_query")] = function
    return function


def bind(function: Callable[[Roles], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: function(Roles(spark, folder))


def money(column: Column | str, scale: int = 4) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return round_half_up(column, scale).cast("double")


def plain(frame: DataFrame, *amounts: str, scale: int = 4) -> DataFrame:
    return frame.withColumns({name: money(name, scale) for name in amounts})


def large(lookup: Lookup) -> Lookup:
    """A lookup that is joined as if it were too large to broadcast."""
    return Lookup(lookup.frame, small=False)


# -- scalars ------------------------------------------------------------------


@query
def regime_decode(r: Roles) -> DataFrame:
    regime = F.col("ind_tipo_regimen_fac")
    special = decode(regime, F.lit("E"), F.col("imp_margen_canal"), F.col("imp_venta"))
    unset = decode(regime, F.lit(None).cast("string"), F.lit("unset"), F.lit("set"))
    return r.lines.select("seq_rec", "seq_reserva", regime, money(special).alias("base"), unset.alias("regime_given"))


@query
def tax_component(r: Roles) -> DataFrame:
    taxed = lines.with_tax(r.lines, r.tax)
    return taxed.select(
        "seq_rec",
        "seq_reserva",
        "cod_impuesto_vta_fac",
        money(embedded_tax(F.col("imp_venta"), F.col("pct_vta"))).alias("venta_tax"),
        money(embedded_tax(F.col("imp_coste"), F.col("pct_cpa"))).alias("coste_tax"),
        money(
            regime_amount(
                F.col("ind_tipo_regimen_con"),
                embedded_tax(F.col("imp_margen_canco"), F.col("pct_vta")),
                F.lit(0.0),
            )
        ).alias("margin_tax"),
    )


@query
def night_amount(r: Roles) -> DataFrame:
    names = ("fec_desde", "fec_hasta", "nro_unidades", "nro_pax", "ind_tipo_unid", "ind_p_s", "imp_unitario")
    stated = F.when(F.col("rext_ord_extra") % 3 == 0, F.col("nro_pax"))
    return r.costs.select(
        "grec_seq_rec",
        "rres_seq_reserva",
        "rext_ord_extra",
        money(measures.cost_nights(r.costs)).alias("nights"),
        money(amount_of_nights(*(F.col(name) for name in names), number_days=stated)).alias("stated_days"),
    )


@query
def round_half_up_query(r: Roles) -> DataFrame:
    half = F.col("l_extendedprice") / 2
    return r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_half_up(half, 0).cast("double").alias("units"),
        round_half_up(half, 2).cast("double").alias("cents"),
        round_half_up(-half, 2).cast("double").alias("credit_cents"),
    )


@query
def round_by_currency(r: Roles) -> DataFrame:
    eighth = F.col("amount") / 8
    amounts = r.booking_amounts.select("booking_id", "booking_currency", eighth.alias("amount"), eighth.alias("partial"))
    known = fx.round_to_currency(amounts, ["amount"], "booking_currency", r.currencies)
    both = fx.round_to_currency(known, ["partial"], "booking_currency", r.currencies_without_kwd)
    return both.select(
        F.col("booking_id").alias("o_orderkey"),
        "booking_currency",
        F.col("amount").cast("double").alias("amount"),
        F.col("partial").cast("double").alias("amount_kwd_unknown"),
    )


@query
def dates_to_midnight(r: Roles) -> DataFrame:
    return with_midnights(without_measures(r.booking_view))


@query
def header_dates(r: Roles) -> DataFrame:
    return r.header.select(
        "seq_reserva",
        F.to_date("fec_creacion").alias("creation_date"),
        day_text(F.col("fec_creacion")).alias("creation_day"),
        second_text(F.col("fec_creacion")).alias("creation_second"),
        nvl(day_text(F.col("fec_modifica")), F.lit("")).alias("modification_date"),
        nvl(second_text(F.col("fec_cancelacion")), F.lit("")).alias("cancellation_ts"),
        F.to_date("fec_desde").alias("booking_service_from"),
    )


@query
def status_date(r: Roles) -> DataFrame:
    changed = latest(F.col("fec_creacion"), F.col("fec_modifica"), F.col("fec_cancelacion"))
    return r.header.select("seq_reserva", F.to_date(changed).alias("status_date"))


@query
def interface_id_query(r: Roles) -> DataFrame:
    return r.header.select(
        "seq_reserva",
        interface_id(F.col("grec_seq_rec"), F.col("seq_reserva")).alias("interface_id"),
        interface_id(F.col("seq_rec_expediente"), F.col("seq_res_expediente")).alias("file_id"),
    )


@query
def holder_clean(r: Roles) -> DataFrame:
    return r.header.select("seq_reserva", strip_semicolons(F.col("nom_general")).alias("holder"))


@query
def booking_flags(r: Roles) -> DataFrame:
    return r.lookup("interfaces").select(F.col("cod_interface").alias("fint_cod_interface"), "partner_ttoo").join(
        r.header, ["fint_cod_interface"], "left"
    ).select(
        "seq_reserva",
        is_set(F.col("fec_cancelacion")).alias("cancelled_booking"),
        is_set(F.col("partner_ttoo")).alias("partner_booking"),
        accommodation_model(F.col("ind_tippag")).alias("accomodation_model"),
    )


@query
def resale_status_query(r: Roles) -> DataFrame:
    statuses = r.resales.select(F.col("seq_rec").alias("grec_seq_rec"), "seq_reserva", "ind_status")
    joined = r.header.join(statuses, ["grec_seq_rec", "seq_reserva"], "left")
    return joined.select("seq_reserva", resale_status(F.col("ind_status"), F.col("fec_cancelacion")).alias("canrec_status"))


@query
def exchange_date_query(r: Roles) -> DataFrame:
    chosen = exchange_date(F.col("ind_fec_cam_div"), F.col("fec_desde"), F.col("fec_creacion"))
    return r.header.select("seq_reserva", F.to_date(chosen).alias("date_ccy_exchange"))


# -- filters and joins --------------------------------------------------------


@query
def daily_extract(r: Roles) -> DataFrame:
    return base_bookings(r.booking_view, RUN_DATE)


@query
def daily_extract_top_n(r: Roles) -> DataFrame:
    return base_bookings(r.booking_view, None, TOP)


@query
def drop_measures(r: Roles) -> DataFrame:
    return without_measures(r.booking_view)


@query
def header_range_filter(r: Roles) -> DataFrame:
    return header.in_created_range(r.header, *RANGE).select("grec_seq_rec", "seq_reserva", "fec_creacion")


@query
def cost_lines_billable(r: Roles) -> DataFrame:
    return measures.billable(r.costs).select("grec_seq_rec", "rres_seq_reserva", "rext_ord_extra", money("imp_unitario").alias("imp_unitario"))


@query
def booking_key_semi(r: Roles) -> DataFrame:
    wanted = measured(
        r.booking_view.filter(F.col("creation_date").between(F.lit(date(1996, 1, 1)), F.lit(date(1997, 12, 31)))).select(*keys.BOOKING)
    )
    rows = keys.in_scope(r.costs, wanted, "grec_seq_rec", "rres_seq_reserva")
    return rows.select("grec_seq_rec", "rres_seq_reserva", "rext_ord_extra", "nro_unidades")


@query
def sale_type_not_in(r: Roles) -> DataFrame:
    return sales.countable(r.sales, sales.NOT_TTV).select(
        "grec_seq_rec_s", "rres_seq_reserva", "ind_tipo_registro", "nro_unidades"
    )


@query
def day_lines_by_key_filter(r: Roles) -> DataFrame:
    days = r.booking_view.filter(F.col("creation_date").between(F.lit(date(1996, 5, 1)), F.lit(date(1996, 5, 31))))
    rows = keys.in_scope(r.lines, Lookup(days.select(*keys.BOOKING), small=False), "seq_rec", "seq_reserva")
    return rows.select("seq_rec", "seq_reserva", "service_type", money("imp_venta").alias("imp_venta"))


def payments(r: Roles) -> Lookup:
    """The payment type of every booking, under the key columns of the sale lines."""
    return measured(
        r.header.select(F.col("grec_seq_rec").alias("grec_seq_rec_s"), F.col("seq_reserva").alias("rres_seq_reserva"), "ind_tippag")
    )


@query
def sale_payment_model_filter(r: Roles) -> DataFrame:
    return sales.charged_lines(r.sales, payments(r)).select(
        "grec_seq_rec_s", "rres_seq_reserva", "ind_tippag", "ind_tipo_registro", "ind_facturable", "nro_unidades"
    )


@query
def service_lines_in_scope(r: Roles) -> DataFrame:
    bookings = measured(
        r.booking_view.select(
            F.col("operative_incoming").alias("seq_rec"),
            F.col("booking_id").alias("seq_reserva"),
            "booking_currency",
            "creation_date",
        )
    )
    return bookings.join(r.lines, ["seq_rec", "seq_reserva"]).select(
        "seq_rec", "seq_reserva", "service_type", "booking_currency", "creation_date", money("imp_venta").alias("imp_venta")
    )


def _percents(taxed: DataFrame) -> DataFrame:
    return taxed.select(
        "seq_rec", "seq_reserva", "cod_impuesto_vta_fac", "pct_vta", "pct_cpa", money("imp_venta").alias("imp_venta")
    )


@query
def tax_join_four_key(r: Roles) -> DataFrame:
    return _percents(lines.with_tax(r.lines, r.tax, tax_type_on_sales_join=False))


@query
def tax_join_five_key(r: Roles) -> DataFrame:
    return _percents(lines.with_tax(r.lines, r.tax))


@query
def left_join_measures(r: Roles) -> DataFrame:
    totals = measures.booking_taxes(r.books()).withColumnsRenamed(
        {"seq_rec": "operative_incoming", "seq_reserva": "booking_id"}
    )
    joined = r.booking_view.select(*keys.BOOKING, "booking_currency").join(totals, list(keys.BOOKING), "left")
    return plain(joined.fillna({"sales_tax": 0.0, "cost_tax": 0.0}), "sales_tax", "cost_tax")


@query
def contract_interval_join(r: Roles) -> DataFrame:
    return header.contract_destinations(r.others, *r.lookups("contracts", "destinations")).distinct()


@query
def contract_interval_bins(r: Roles) -> DataFrame:
    return header.contract_destinations(r.others, large(r.lookup("contracts")), r.lookup("destinations")).distinct()


@query
def coalesced_key_join(r: Roles) -> DataFrame:
    return header.with_operator_and_market(r.header, *r.lookups("operators", "countries")).select(
        "seq_reserva", "cod_pais_cliente", "gpai_cod_pais_mercado", "source_market", "source_market_iso"
    )


@query
def concat_key_join(r: Roles) -> DataFrame:
    merged = header.merged_measures(r.measure_views)
    joined = r.header.select("grec_seq_rec", "seq_reserva").join(merged, list(header.KEY), "left")
    names = [name for name in merged.columns if name not in header.KEY]
    return joined.select("grec_seq_rec", "seq_reserva", *(money(nvl(F.col(name), F.lit(0.0))).alias(name) for name in names))


@query
def first_row_join(r: Roles) -> DataFrame:
    first = header.first_application(r.information)
    return r.header.select(*header.KEY).join(first, list(header.KEY), "left")


# -- exclusions, unions, aggregates -------------------------------------------


@query
def exclusion_keys(r: Roles) -> DataFrame:
    return r.books().exclusions()


@query
def unprofitable_anti(r: Roles) -> DataFrame:
    by_extra = r.lines.filter(F.col("service_type") == "extra").groupBy(*exclusions.EXTRA).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("imp_venta").alias("venta")
    )
    return plain(exclusions.without_excluded(by_extra, r.books().exclusions()), "venta")


@query
def cost_anti(r: Roles) -> DataFrame:
    return plain(measures.included_costs(r.books()), "nights")


@query
def service_union(r: Roles) -> DataFrame:
    union = lines.service_lines(r.service_tables())
    return union.select("seq_rec", "seq_reserva", "ord_extra", "service_type", money("imp_venta").alias("imp_venta"))


@query
def union_then_sum(r: Roles) -> DataFrame:
    union = lines.service_lines(r.service_tables())
    sums = union.groupBy("seq_rec", "seq_reserva").agg(
        F.sum("imp_venta").alias("venta"), F.sum("imp_coste").alias("coste")
    )
    return plain(sums, "venta", "coste")


@query
def null_safe_total(r: Roles) -> DataFrame:
    books = r.books()
    priced = measures.priced_bookings(r.booking_view.select(*keys.BOOKING, "creation_date", "booking_currency"), r.fx)
    names = {"seq_rec": "operative_incoming", "seq_reserva": "booking_id"}
    costs = measures.cost_by_booking(books, priced).withColumnsRenamed(names)
    taxes = measures.booking_taxes(books).withColumnsRenamed(names)
    joined = priced.join(taxes, list(keys.BOOKING), "left").join(costs, list(keys.BOOKING), "left")
    filled = measures.null_safe_total(joined, "cost_tax", "cost_field", "total")
    lossy = measures.null_safe_total(filled, "cost_tax", "cost_field", "total_fill_after", fill_each=False)
    return lossy.select(*keys.BOOKING, money("total", 2).alias("total"), money("total_fill_after", 2).alias("total_fill_after"))


@query
def tax_sales_by_booking(r: Roles) -> DataFrame:
    return plain(measures.booking_taxes(r.books()).select("seq_rec", "seq_reserva", "sales_tax"), "sales_tax")


@query
def first_booking_ts(r: Roles) -> DataFrame:
    return r.header.select(*header.KEY).join(header.first_booking_ts(r.information), list(header.KEY))


@query
def active_services(r: Roles) -> DataFrame:
    return header.active_services(r.hotel_sales)


# -- currency conversion ------------------------------------------------------


@query
def fx_asof(r: Roles) -> DataFrame:
    dated = r.fx.with_snapshot(r.booking_view.select("booking_id", "creation_date", "booking_currency"), F.col("creation_date"))
    general = r.fx.with_rate(dated, F.col("booking_currency"), "rate_m")
    return r.fx.with_rate(general, F.col("booking_currency"), "rate_r", "R")


@query
def fx_convert(r: Roles) -> DataFrame:
    rows = r.costs.select(
        "grec_seq_rec", "rres_seq_reserva", "rext_ord_extra", "sdiv_cod_divisa", "fec_desde", "imp_unitario"
    )
    # One snapshot and one rate of the source serve all targets of a rate type.
    dated = r.fx.with_snapshot(rows, F.col("fec_desde"))
    outputs = []
    for kind, targets in (("M", {"eur": EUR, "usd": "USD"}), ("R", {"eur_type_r": EUR})):
        dated = r.fx.with_rate(dated, F.col("sdiv_cod_divisa"), f"from_{kind}", kind)
        for out, code in targets.items():
            dated = r.fx.with_rate(dated, code, f"to_{out}", kind)
            outputs.append(fx.exchanged(F.col("imp_unitario"), F.col(f"from_{kind}"), F.col(f"to_{out}")).alias(out))
    converted = dated.select("grec_seq_rec", "rres_seq_reserva", "rext_ord_extra", *outputs)
    return plain(converted, "eur", "usd", "eur_type_r")


@query
def fx_convert_round3(r: Roles) -> DataFrame:
    priced = measures.priced_bookings(r.booking_amounts, r.fx)
    return priced.select(
        "booking_id",
        fx.exchanged_cents(F.col("amount"), F.col("booking_rate"), F.col("eur_rate")).cast("double").alias("total_eur"),
    )


@query
def daily_rate_join(r: Roles) -> DataFrame:
    dated = with_daily_rate(r.header.select("seq_reserva", "fec_creacion", "gdiv_cod_divisa", "pct_comision"), r.lookup("daily_rates"))
    product = nvl(F.col("pct_comision"), F.lit(0.0)) * nvl(F.col("day_rate"), F.lit(0.0))
    return dated.select("seq_reserva", "gdiv_cod_divisa", money("day_rate").alias("day_rate"), money(product).alias("product"))


def _with_spread(r: Roles, spreads: Lookup) -> DataFrame:
    sides = F.array(*(F.lit(code) for code in ("V", "C", "F", "Z")))
    bookings = r.booking_amounts.withColumns(
        {"spread": F.element_at(sides, (F.col("booking_id") % 4 + 1).cast("int")), "target": F.lit(EUR)}
    )
    day = F.col("creation_date")
    converted = r.fx.convert(bookings, F.col("amount"), F.col("booking_currency"), EUR, day, "eur")
    raised = fx.with_spread(converted, spreads, "M", "booking_currency", "target", "creation_date", "spread", "eur", "eur_with_spread")
    return raised.select("booking_id", "spread", money("eur", 2).alias("eur"), money("eur_with_spread", 2).alias("eur_with_spread"))


@query
def fx_with_spread(r: Roles) -> DataFrame:
    return _with_spread(r, r.spreads)


@query
def fx_with_spread_merge(r: Roles) -> DataFrame:
    return _with_spread(r, large(r.spreads))


def _company_rate_type(r: Roles, settings: Lookup) -> DataFrame:
    purposes = F.element_at(
        F.array(*(F.lit(code) for code in ("R", "C", "L", "A", "M"))), (F.col("booking_id") % 5 + 1).cast("int")
    )
    bookings = r.booking_view.select("booking_id", "invoicing_company", "creation_date", purposes.alias("purpose"))
    return fx.company_rate_type(bookings, settings, "invoicing_company", "creation_date", "purpose", "cod_exchange_type")


@query
def company_rate_type_asof(r: Roles) -> DataFrame:
    return _company_rate_type(r, r.company_rate_types)


@query
def company_rate_type_merge(r: Roles) -> DataFrame:
    return _company_rate_type(r, large(r.company_rate_types))


def _partner_rate(r: Roles, rates: Lookup) -> DataFrame:
    bookings = r.header.select(
        "seq_reserva", "gtto_seq_ttoo", F.to_date("fec_creacion").alias("created_on"), "gdiv_cod_divisa"
    ).withColumn("target", F.lit(EUR))
    rated = fx.partner_rate(bookings, rates, "gtto_seq_ttoo", "gdiv_cod_divisa", "target", "created_on", "rate")
    return rated.select("seq_reserva", "gtto_seq_ttoo", "gdiv_cod_divisa", money("rate").alias("rate"))


@query
def partner_rate_asof(r: Roles) -> DataFrame:
    return _partner_rate(r, r.lookup("partner_rates"))


@query
def partner_rate_merge(r: Roles) -> DataFrame:
    return _partner_rate(r, large(r.lookup("partner_rates")))


def _event_values(r: Roles) -> tuple[DataFrame, DataFrame]:
    """Events, and the highest value of a user's purchases at each instant."""
    events = r.table("events")
    bought = events.filter(F.col("event_type") == "purchase").groupBy(F.col("user_id").alias("buyer"), F.col("ts").alias("bought_at"))
    return events.select("event_id", "user_id", "ts"), bought.agg(F.max("value").alias("bought_value"))


@query
def last_purchase_asof(r: Roles) -> DataFrame:
    events, bought = _event_values(r)
    matched = asof.merged(events, bought, [("user_id", "buyer")], "ts", "bought_at")
    return matched.select("event_id", "user_id", "bought_at", "bought_value")


@query
def next_purchase_asof(r: Roles) -> DataFrame:
    events, bought = _event_values(r)
    matched = asof.merged(events, bought, [("user_id", "buyer")], "ts", "bought_at", forward=True)
    return matched.select("event_id", "user_id", "bought_at", "bought_value")


# -- measures -----------------------------------------------------------------


def _base(r: Roles) -> DataFrame:
    return r.booking_view.select(*keys.BOOKING, "creation_date", "booking_currency")


def _measure(r: Roles, name: str, eur: bool) -> DataFrame:
    out = measures.EUR_NAMES[name] if eur else name
    frame = measures.with_measures(r.books(), _base(r), (name,))
    return frame.select(*keys.BOOKING, "booking_currency", F.col(out).cast("double").alias(out))


@query
def tax_sales_transfer_pricing(r: Roles) -> DataFrame:
    return _measure(r, measures.SALES_TAX, eur=False)


@query
def tax_cost_transfer_pricing(r: Roles) -> DataFrame:
    return _measure(r, measures.COST_TAX, eur=False)


@query
def transfer_pricing(r: Roles) -> DataFrame:
    return _measure(r, measures.TRANSFER, eur=False)


@query
def tax_sales_transfer_pricing_eur(r: Roles) -> DataFrame:
    return _measure(r, measures.SALES_TAX, eur=True)


@query
def tax_cost_transfer_pricing_eur(r: Roles) -> DataFrame:
    return _measure(r, measures.COST_TAX, eur=True)


@query
def transfer_pricing_eur(r: Roles) -> DataFrame:
    return _measure(r, measures.TRANSFER, eur=True)


@query
def transfer_price_by_booking(r: Roles) -> DataFrame:
    priced = measures.priced_bookings(_base(r), r.fx)
    return plain(measures.transfer_price_by_booking(r.books(), priced), "impuesto_canco", scale=2)


@query
def cost_by_booking(r: Roles) -> DataFrame:
    return plain(measures.cost_by_booking(r.books(), measures.priced_bookings(_base(r), r.fx)), "cost_field", scale=2)


@query
def cost_by_booking_eur(r: Roles) -> DataFrame:
    return plain(measures.cost_by_booking(r.books(), measures.priced_bookings(_base(r), r.fx), EUR), "cost_field", scale=2)


def _line_level(r: Roles, name: str) -> DataFrame:
    out = measures.EUR_NAMES[name]
    frame = measures.line_level_eur(r.books(), _base(r), name)
    return plain(frame.select(*keys.BOOKING, out), out, scale=2)


@query
def tax_sales_eur_line_level(r: Roles) -> DataFrame:
    return _line_level(r, measures.SALES_TAX)


@query
def transfer_eur_line_level(r: Roles) -> DataFrame:
    return _line_level(r, measures.TRANSFER)


@query
def cost_eur_line_level(r: Roles) -> DataFrame:
    return _line_level(r, measures.COST_TAX)


@query
def sale_tax_lines(r: Roles) -> DataFrame:
    rows = sales.sale_tax_lines(r.sales, r.tax, measured(r.header), sales.GENERAL)
    return rows.select(
        "grec_seq_rec_s",
        "rres_seq_reserva",
        F.to_date("date_ccy_exchange").alias("date_ccy_exchange"),
        "regime",
        money("tax_aux").alias("tax_aux"),
    )


@query
def ttv_by_booking(r: Roles) -> DataFrame:
    totals = sales.ttv_by_booking(r.sales, r.header.select(*header.KEY, "ind_tippag"))
    return plain(totals.drop("ind_tippag"), "TTV_booking_currency")


def _tax_ttv(r: Roles, **regimes: str) -> DataFrame:
    totals = sales.tax_ttv(r.sales, r.tax, r.header.select(*header.KEY, "ind_tippag"), regimes)
    return plain(totals.drop("ind_tippag"), *regimes)


@query
def tax_ttv(r: Roles) -> DataFrame:
    return _tax_ttv(r, Tax_TTV=sales.GENERAL)


@query
def tax_ttv_toms(r: Roles) -> DataFrame:
    return _tax_ttv(r, Tax_TTV_TOMS=sales.TOMS)


# -- header -------------------------------------------------------------------


@query
def booking_header(r: Roles) -> DataFrame:
    return header.booking_header(r.header, *r.lookups("operators", "countries", "receptives", "interfaces"))


@query
def first_hotel_destination(r: Roles) -> DataFrame:
    return header.first_hotel_destination(r.hotel_sales, *r.lookups("hotels", "destinations"))


@query
def first_contract_destination(r: Roles) -> DataFrame:
    return header.first_contract_destination(r.others, *r.lookups("contracts", "destinations"))


@query
def first_application(r: Roles) -> DataFrame:
    return header.first_application(r.information)


@query
def distinct_destinations(r: Roles) -> DataFrame:
    return header.distinct_destinations(r.hotel_sales, *r.lookups("hotels", "destinations"))


@query
def dedup_by_key(r: Roles) -> DataFrame:
    rows = header.distinct_destinations(r.hotel_sales, *r.lookups("hotels", "destinations"))
    return keys.first_per_key(rows, header.KEY, ["izge_cod_destino", "nom_destino"])


@query
def destination_code(r: Roles) -> DataFrame:
    return header.with_destination_code(
        r.header.select(*header.KEY), first_hotel_destination(r), first_contract_destination(r)
    )


@query
def booking_extract_wide(r: Roles) -> DataFrame:
    wide = build_wide_extract(r.header_tables(), *WIDE_RANGE)
    return plain(wide, *(name for name, kind in wide.dtypes if kind == "double"), scale=2)


# -- assembly -----------------------------------------------------------------


def _doubles(frame: DataFrame) -> DataFrame:
    return frame.withColumns({name: F.col(name).cast("double") for name, kind in frame.dtypes if kind.startswith("decimal")})


@query
def assemble_extract(r: Roles) -> DataFrame:
    # One frame holds all measures, so the lines are read and summed once.
    frame = measures.with_measures(r.books(), _base(r)).drop("creation_date", "booking_currency")
    return _doubles(assemble(without_measures(r.booking_view), frame))


@query
def daily_extract_full(r: Roles) -> DataFrame:
    return _doubles(build_extract(r.books(), r.booking_view))


@query
def daily_extract_one_day(r: Roles) -> DataFrame:
    return _doubles(build_extract(r.books(), r.booking_view, RUN_DATE))


# -- inputs and SQL -----------------------------------------------------------


@query
def input_contract(r: Roles) -> DataFrame:
    keyed = {
        "tax": (r.tax.frame, [column for _, column in lines.TAX_KEY]),
        "tax_any_type": (r.tax.frame, [column for _, column in lines.TAX_KEY[1:]]),
        "currency": (r.currencies.frame, ["cod_divisa"]),
        "booking_interface": (r.booking_view, keys.BOOKING),
        "booking": (r.header, header.KEY),
        "resale": (r.resales, ["seq_rec", "seq_reserva"]),
        "tour_operator": (r.lookup("operators").frame, ["seq_ttoo"]),
        "country": (r.lookup("countries").frame, ["cod_pais"]),
        "receptive": (r.lookup("receptives").frame, ["seq_rec"]),
        "interface": (r.lookup("interfaces").frame, ["cod_interface"]),
        "market_of_customer": (r.header, ["cod_pais_cliente"]),
        "hotel_master": (r.lookup("hotels").frame, ["seq_hotel"]),
    }
    held = {
        "service": contract.Lines(r.lines, "seq_rec", "seq_reserva", "imp_venta", contract.service_needs()),
        "cost": contract.Lines(r.costs, "grec_seq_rec", "rres_seq_reserva", "imp_unitario"),
        "sale": contract.Lines(r.sales, "grec_seq_rec_s", "rres_seq_reserva", "imp_unitario", {contract.NO_SALES_TAX: sales.SALE_TAX_KEY}),
        # Applications are logged for numbers that are no bookings.
        "booking_information": contract.Lines(r.information.withColumn("one", F.lit(1.0)), "seq_rec", "seq_reserva", "one"),
    }
    ledger = contract.input_contract(keyed, held, r.tax, measured(r.booking_view.select(*keys.BOOKING)))
    return plain(ledger, "amount", scale=2)


@query
def taxes_by_day_sql(r: Roles) -> DataFrame:
    bookings = r.booking_view.select(*keys.BOOKING, "creation_date", "booking_currency")
    by_sql = SqlMeasures(r.spark, r.books(), bookings)
    return plain(by_sql.taxes_by_day(date(1996, 1, 1), date(1997, 12, 31)), "sales_tax", "cost_tax", scale=2)
