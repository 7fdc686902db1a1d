"""Explicit schemas of the source tables, as DDL; nothing is inferred."""

from __future__ import annotations

_LINE = """
    seq_rec bigint, seq_reserva bigint, {extra}
    ind_tipo_regimen_fac string, ind_tipo_regimen_con string,
    imp_venta double, imp_coste double, imp_margen_canal double, imp_margen_canco double,
    ind_tipo_imp_vta_fac string, cod_impuesto_vta_fac string, cod_clasif_vta_fac string,
    cod_esquema_vta_fac string, cod_empresa_vta_fac string
"""

SCHEMAS = {
    "booking_interface": """
        operative_incoming bigint, booking_id bigint, invoicing_company string, creation_date date,
        booking_currency string, modification_date string, cancellation_date string, status_date date,
        booking_service_from date, booking_service_to date
    """,
    "hotel": _LINE.format(extra=""),
    "circuit": _LINE.format(extra=""),
    "other": _LINE.format(extra=""),
    "transfer": _LINE.format(extra=""),
    "endowments": _LINE.format(extra=""),
    "extra": _LINE.format(extra="ord_extra bigint,"),
    "tax": """
        ind_tipo_imp string, cod_impuesto string, cod_clasif string, cod_esquema string,
        cod_emp_atlas string, pct_impuesto double
    """,
    "extra_bond": """
        grec_seq_rec bigint, rres_seq_reserva bigint, ord_extra bigint, num_bono bigint, cod_interface string
    """,
    "discount_bond": "num_bono bigint, cod_interface string, cod_campana string",
    "campaign": "cod_campana string, cod_interface string, ind_rentabilidad string",
    "cost": """
        grec_seq_rec bigint, rres_seq_reserva bigint, rext_ord_extra bigint, sdiv_cod_divisa string,
        fec_desde timestamp_ntz, fec_hasta timestamp_ntz, nro_unidades int, nro_pax int,
        ind_tipo_unid string, ind_p_s string, imp_unitario double,
        ind_tipo_registro string, ind_facturable string
    """,
    "sale": """
        grec_seq_rec_s bigint, rres_seq_reserva bigint, fec_desde_s timestamp_ntz, fec_hasta_s timestamp_ntz,
        nro_unidades int, nro_pax int, ind_tipo_unid string, ind_p_s string, imp_unitario double,
        ind_tipo_registro string, ind_facturable string, ind_contra_apunte string, imp_impuesto double,
        ind_tipo_regimen string, ind_trfprc string, rvp_ind_tipo_imp string, rvp_cod_impuesto string,
        rvp_cod_esquema string, rvp_cod_clasif string, rvp_cod_empresa string
    """,
    "currency": "cod_divisa string, decimales int",
    "fx_rate": "rate_type string, snapshot_date date, currency string, rate double",
    "contract_other": """
        seq_rec bigint, nom_contrato string, ind_tipo_otro string, fec_desde date, fec_hasta date, cod_destino string
    """,
    "other_service": """
        seq_rec bigint, seq_reserva bigint, nom_contrato string, ind_tipo_otro string, fec_desde date
    """,
    "booking_information": """
        seq_rec bigint, seq_reserva bigint, fec_creacion timestamp_ntz, tipo_op string, aplicacion string
    """,
    "booking": """
        grec_seq_rec bigint, seq_reserva bigint, gdiv_cod_divisa string, fec_creacion timestamp_ntz,
        fec_modifica timestamp_ntz, fec_cancelacion timestamp_ntz, fec_desde timestamp_ntz, fec_hasta timestamp_ntz,
        gtto_seq_ttoo bigint, cod_pais_cliente string, nro_ad int, nro_ni int, fint_cod_interface string,
        seq_rec_invoicing bigint, nom_general string, ind_tipo_credito string, gdep_cod_depart string,
        rtre_cod_tipo_res string, ind_facturable_res string, ind_facturable_adm string, pct_comision double,
        pct_rappel double, ind_confirma string, cod_divisa_p string, seq_ttoo_p bigint, cod_suc_p bigint,
        seq_agencia_p bigint, seq_sucursal_p bigint, seq_rec_expediente bigint, seq_res_expediente bigint,
        ind_tippag string, ind_fec_cam_div string
    """,
    "tour_operator": "seq_ttoo bigint, nom_corto_ttoo string, gpai_cod_pais_mercado string",
    "country": "cod_pais string, cod_iso string",
    "receptive": "seq_rec bigint, semp_cod_emp string, sofi_cod_ofi string, des_receptivo string",
    "interface": "cod_interface string, partner_ttoo string",
    "hotel_sale": """
        grec_seq_rec bigint, rres_seq_reserva bigint, ghor_seq_hotel bigint, fec_cancelacion timestamp_ntz
    """,
    "hotel_master": "seq_hotel bigint, izge_cod_destino string",
    "destination": "ides_cod_destino string, nom_destino string, sidi_cod_idioma string",
    "resale": "seq_rec bigint, seq_reserva bigint, ind_status string",
    "daily_rate": "date date, currency string, rate double",
}
