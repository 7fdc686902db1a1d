"""Booking header: descriptive fields joined from dimensions and from first rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.functions.scalars import (
    accommodation_model,
    day_text,
    destination_code,
    interface_id,
    is_set,
    latest,
    strip_semicolons,
)
from stayledger.operators.asof import within_interval
from stayledger.operators.keys import first_per_key
from stayledger.operators.lookup import Lookup

KEY = ("grec_seq_rec", "seq_reserva")


def in_created_range(header: DataFrame, start: str, end: str) -> DataFrame:
    """Bookings created in a closed timestamp range, placeholder numbers left out; both tests reach the scan."""
    created = F.col("fec_creacion")
    bounds = (F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    return header.filter(created.between(*bounds) & (F.col("seq_reserva") > 0))


def with_operator(header: DataFrame, operators: Lookup) -> DataFrame:
    """Attach the tour operator; bookings without one are dropped."""
    return operators.select(F.col("seq_ttoo").alias("gtto_seq_ttoo"), "nom_corto_ttoo", "gpai_cod_pais_mercado").join(
        header, ["gtto_seq_ttoo"]
    )


def with_market(sold: DataFrame, countries: Lookup) -> DataFrame:
    """Attach the country of the client or else of the operator's market; bookings without one are dropped."""
    sold = sold.withColumn("source_market", F.coalesce("cod_pais_cliente", "gpai_cod_pais_mercado"))
    return countries.select(F.col("cod_pais").alias("source_market"), F.col("cod_iso").alias("source_market_iso")).join(
        sold, ["source_market"]
    )


def with_operator_and_market(header: DataFrame, operators: Lookup, countries: Lookup) -> DataFrame:
    """Attach the tour operator, and the country of the client or else of the operator's market.

    Bookings without an operator or a country are dropped.
    """
    return with_market(with_operator(header, operators), countries)


def operator_beside(rows: DataFrame, header: DataFrame, operators: Lookup) -> DataFrame:
    """``with_operator`` of rows that are laid out by booking, for operators too large to broadcast.

    ``rows`` are the bookings of ``header`` with more columns. What moves to the operators and back are the bookings'
    numbers and what is found for them, not the rows. Every row must have its office, for it is matched by equality.
    """
    found = with_operator(header.select(*KEY, "gtto_seq_ttoo").distinct(), operators)
    found = found.withColumnsRenamed({"gtto_seq_ttoo": "_operator"} | {name: f"_{name}" for name in KEY})
    # A booking number that comes twice may have two operators. As a plain equality that test would be one more key of
    # the join, which in Spark's default settings moves the rows again.
    same = F.col("gtto_seq_ttoo").between(F.col("_operator"), F.col("_operator"))
    for name in KEY:
        same = same & (F.col(name) == F.col(f"_{name}"))
    return rows.join(found, same).drop("_operator", *(f"_{name}" for name in KEY))


def with_receptives(header: DataFrame, receptives: Lookup) -> DataFrame:
    """Attach one dimension in two roles: the operating (``_re``) and the invoicing (``_rf``) office."""

    def role(key: str, suffix: str) -> Lookup:
        return receptives.select(
            F.col("seq_rec").alias(key),
            F.col("seq_rec").alias(f"seq_rec_{suffix}"),
            F.col("semp_cod_emp").alias(f"semp_cod_emp_{suffix}"),
            F.col("sofi_cod_ofi").alias(f"sofi_cod_ofi_{suffix}"),
            F.col("des_receptivo").alias(f"des_receptivo_{suffix}"),
        )

    operating = role("grec_seq_rec", "re").join(header, ["grec_seq_rec"], "left")
    return role("seq_rec_invoicing", "rf").join(operating, ["seq_rec_invoicing"], "left")


def with_interface(header: DataFrame, interfaces: Lookup) -> DataFrame:
    sides = interfaces.select(F.col("cod_interface").alias("fint_cod_interface"), "partner_ttoo")
    return sides.join(header, ["fint_cod_interface"], "left")


def with_dimensions(
    header: DataFrame, operators: Lookup, countries: Lookup, receptives: Lookup, interfaces: Lookup
) -> DataFrame:
    sold = with_operator_and_market(header, operators, countries)
    return with_interface(with_receptives(sold, receptives), interfaces)


# Output field and the column it is read from.
PLAIN_FIELDS = (
    ("operative_company", "semp_cod_emp_re"),
    ("operative_office", "sofi_cod_ofi_re"),
    ("operative_office_desc", "des_receptivo_re"),
    ("operative_incoming", "grec_seq_rec"),
    ("booking_id", "seq_reserva"),
    ("interface", "fint_cod_interface"),
    ("invoicing_company", "semp_cod_emp_rf"),
    ("invoicing_office", "sofi_cod_ofi_rf"),
    ("invoicing_incoming", "seq_rec_rf"),
    ("Creation_ts", "fec_creacion"),
    ("modification_ts", "fec_modifica"),
    ("cancellation_ts", "fec_cancelacion"),
    ("booking_service_from", "fec_desde"),
    ("booking_service_to", "fec_hasta"),
    ("client_code", "gtto_seq_ttoo"),
    ("costumer_name", "nom_corto_ttoo"),
    ("Source_market", "source_market"),
    ("source_market_iso", "source_market_iso"),
    ("num_adults", "nro_ad"),
    ("num_childrens", "nro_ni"),
    ("Department_code", "gdep_cod_depart"),
    ("Booking_type", "rtre_cod_tipo_res"),
    ("Invoicing_booking", "ind_facturable_res"),
    ("Invoicing_admin", "ind_facturable_adm"),
    ("Client_commision_esp", "pct_comision"),
    ("client_override_esp", "pct_rappel"),
    ("confirmed_booking", "ind_confirma"),
    ("Partner_booking_currency", "cod_divisa_p"),
    ("Partner_code", "seq_ttoo_p"),
    ("Partner_brand", "cod_suc_p"),
    ("Partner_agency_code", "seq_agencia_p"),
    ("Partner_agency_brand", "seq_sucursal_p"),
    ("Booking_file_incoming", "seq_rec_expediente"),
    ("booking_file_number", "seq_res_expediente"),
    ("Booking_currency", "gdiv_cod_divisa"),
)

# Source columns kept next to the output fields for the measures.
CARRIED = (
    "grec_seq_rec",
    "seq_reserva",
    "semp_cod_emp_re",
    "semp_cod_emp_rf",
    "fec_desde",
    "fec_creacion",
    "gdiv_cod_divisa",
    "ind_tippag",
    "ind_fec_cam_div",
)


# Output fields in published order, after the carried columns.
PUBLISHED = (
    "interface_id",
    "operative_company",
    "operative_office",
    "operative_office_desc",
    "operative_incoming",
    "booking_id",
    "interface",
    "invoicing_company",
    "invoicing_office",
    "invoicing_incoming",
    "Creation_date",
    "Creation_ts",
    "modification_date",
    "modification_ts",
    "cancellation_date",
    "cancellation_ts",
    "cancelled_booking",
    "status_date",
    "booking_service_from",
    "booking_service_to",
    "client_code",
    "costumer_name",
    "Source_market",
    "source_market_iso",
    "Holder",
    "num_adults",
    "num_childrens",
    "Department_code",
    "Booking_type",
    "Invoicing_booking",
    "Invoicing_admin",
    "Client_commision_esp",
    "client_override_esp",
    "confirmed_booking",
    "Partner_booking",
    "Partner_booking_currency",
    "Partner_code",
    "Partner_brand",
    "Partner_agency_code",
    "Partner_agency_brand",
    "Booking_file_incoming",
    "booking_file_number",
    "Accomodation_model",
    "Booking_currency",
)


def booking_flags(dimensioned: DataFrame) -> DataFrame:
    """Three flags that read a missing value: cancelled, sold by a partner, who collects the payment."""
    return dimensioned.withColumns(
        {
            "cancelled_booking": is_set(F.col("fec_cancelacion")),
            "Partner_booking": is_set(F.col("partner_ttoo")),
            "Accomodation_model": accommodation_model(F.col("ind_tippag")),
        }
    )


def booking_header(
    header: DataFrame, operators: Lookup, countries: Lookup, receptives: Lookup, interfaces: Lookup
) -> DataFrame:
    """The header fields of each booking under their published names, next to the carried source columns."""
    flagged = booking_flags(with_dimensions(header, operators, countries, receptives, interfaces))
    changed_at = latest(F.col("fec_creacion"), F.col("fec_modifica"), F.col("fec_cancelacion"))
    fields = {name: F.col(source) for name, source in PLAIN_FIELDS} | {
        "interface_id": interface_id(F.col("grec_seq_rec"), F.col("seq_reserva")),
        "Creation_date": day_text(F.col("fec_creacion")),
        "modification_date": day_text(F.col("fec_modifica")),
        "cancellation_date": day_text(F.col("fec_cancelacion")),
        "status_date": day_text(changed_at),
        "Holder": strip_semicolons(F.col("nom_general")),
        "cancelled_booking": F.col("cancelled_booking"),
        "Partner_booking": F.col("Partner_booking"),
        "Accomodation_model": F.col("Accomodation_model"),
    }
    return flagged.select(*CARRIED, *(fields[name].alias(name) for name in PUBLISHED))


def first_booking_ts(information: DataFrame, creations_only: bool = False) -> DataFrame:
    """Earliest information entry per booking."""
    rows = information.filter(F.col("tipo_op") == "A") if creations_only else information
    return rows.groupBy(F.col("seq_rec").alias(KEY[0]), "seq_reserva").agg(
        F.min("fec_creacion").alias("first_booking_ts")
    )


def first_application(information: DataFrame) -> DataFrame:
    """Application of the earliest creation entry per booking."""
    created = information.filter(F.col("tipo_op") == "A")
    first = first_per_key(created, ["seq_rec", "seq_reserva"], ["fec_creacion", "aplicacion"])
    return first.select(F.col("seq_rec").alias(KEY[0]), "seq_reserva", "aplicacion")


def first_entries(information: DataFrame) -> DataFrame:
    """Time and application of the earliest creation entry per booking, in one pass."""
    created = information.filter(F.col("tipo_op") == "A")
    first = F.min(F.struct("fec_creacion", "aplicacion"))
    return (
        created.groupBy(F.col("seq_rec").alias(KEY[0]), "seq_reserva")
        .agg(first.alias("_first"), F.min("fec_creacion").alias("first_booking_ts"))
        .select(*KEY, "first_booking_ts", F.col("_first.aplicacion").alias("aplicacion"))
    )


def english(destinations: Lookup) -> Lookup:
    return destinations.filter(F.col("sidi_cod_idioma") == "ENG")


def hotel_destinations(hotel_sales: DataFrame, hotels: Lookup, destinations: Lookup) -> DataFrame:
    """Hotel sales with the destination of their hotel; sales without one are dropped."""
    located = hotels.select(F.col("seq_hotel").alias("ghor_seq_hotel"), "izge_cod_destino").join(
        hotel_sales, ["ghor_seq_hotel"]
    )
    named = english(destinations).select(F.col("ides_cod_destino").alias("izge_cod_destino"), "nom_destino")
    return named.join(located, ["izge_cod_destino"]).select(
        F.col("grec_seq_rec"),
        F.col("rres_seq_reserva").alias("seq_reserva"),
        "ghor_seq_hotel",
        "izge_cod_destino",
        "nom_destino",
    )


def distinct_destinations(hotel_sales: DataFrame, hotels: Lookup, destinations: Lookup) -> DataFrame:
    return (
        hotel_destinations(hotel_sales, hotels, destinations)
        .select(*KEY, "izge_cod_destino", "nom_destino")
        .distinct()
    )


def first_hotel_destination(hotel_sales: DataFrame, hotels: Lookup, destinations: Lookup) -> DataFrame:
    """Destination of each booking's lowest-numbered hotel."""
    rows = hotel_destinations(hotel_sales, hotels, destinations)
    return first_per_key(rows, KEY, ["ghor_seq_hotel", "izge_cod_destino", "nom_destino"]).select(
        *KEY, "izge_cod_destino", "nom_destino"
    )


def contract_destinations(others: DataFrame, contracts: Lookup, destinations: Lookup) -> DataFrame:
    """Other services with the destination of every contract in force on their start date."""
    terms = contracts.select(
        F.col("seq_rec").alias("_rec"),
        F.col("nom_contrato").alias("_contract"),
        F.col("ind_tipo_otro").alias("_type"),
        F.col("fec_desde").alias("contract_from"),
        F.col("fec_hasta").alias("contract_to"),
        "cod_destino",
    )
    on = [("seq_rec", "_rec"), ("nom_contrato", "_contract"), ("ind_tipo_otro", "_type")]
    matched = within_interval(others, terms, on, F.col("fec_desde"), F.col("contract_from"), F.col("contract_to"))
    named = english(destinations).select(
        F.col("ides_cod_destino").alias("cod_destino"), F.col("nom_destino").alias("nom_destino2")
    )
    return named.join(matched, ["cod_destino"]).select(
        F.col("seq_rec").alias(KEY[0]), "seq_reserva", "nom_contrato", "contract_from", "cod_destino", "nom_destino2"
    )


def first_contract_destination(others: DataFrame, contracts: Lookup, destinations: Lookup) -> DataFrame:
    """Destination of each booking's first contract by name, then by start and destination."""
    rows = contract_destinations(others, contracts, destinations)
    return first_per_key(rows, KEY, ["nom_contrato", "contract_from", "cod_destino", "nom_destino2"]).select(
        *KEY, "cod_destino", "nom_destino2"
    )


def with_destination_code(bookings: DataFrame, first_hotels: DataFrame, first_contracts: DataFrame) -> DataFrame:
    joined = bookings.join(first_hotels, list(KEY), "left").join(first_contracts, list(KEY), "left")
    code = destination_code(
        F.col("izge_cod_destino"), F.col("nom_destino"), F.col("cod_destino"), F.col("nom_destino2")
    )
    return joined.withColumn("Destination_code", code).drop(
        "izge_cod_destino", "nom_destino", "cod_destino", "nom_destino2"
    )


def active_services(hotel_sales: DataFrame) -> DataFrame:
    """Hotel services per booking that are not cancelled."""
    return (
        hotel_sales.filter(F.col("fec_cancelacion").isNull())
        .groupBy("grec_seq_rec", F.col("rres_seq_reserva").alias("seq_reserva"))
        .agg(F.count(F.lit(1)).alias("act_services"))
    )


def merged_measures(views: list[DataFrame]) -> DataFrame:
    """Per-booking measure views as one row per booking.

    The views are stacked and summed by booking, one shuffle for all of them
    instead of one join per view. A column a view lacks stays null.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), views)
    measures = [name for name in stacked.columns if name not in ("grec_seq_rec", "rres_seq_reserva")]
    return stacked.groupBy("grec_seq_rec", F.col("rres_seq_reserva").alias("seq_reserva")).agg(
        *(F.sum(name).alias(name) for name in measures)
    )
