"""The same queries as plain SQL, written line by line where the engine sums first.

Statements are assembled from named table expressions; each carries the ones it
mentions and no others.
"""

from __future__ import annotations

import re

from workload import values
from workload.queries import RANGE, RUN_DATE, TOP, WIDE_RANGE
from workload.roles import COST_MEASURES, FEE_MEASURES, OFFICES, SALE_MEASURES


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS DOUBLE)" if isinstance(value, float) else str(value)


def _values(columns: str, rows: tuple) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def currency(number: str) -> str:
    codes = ", ".join(f"'{code}'" for code in values.CURRENCIES)
    return f"([{codes}])[CAST({number} % 5 AS INTEGER) + 1]"


def exact(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(28,6))"


def money(amount: str, scale: int = 4) -> str:
    return f"CAST(round({exact(amount)}, {scale}) AS DOUBLE)"


def tax_in(gross: str, percent: str) -> str:
    return f"({gross}) * (1 - (1 / nullif(1 + {percent} / 100, 0)))"


def currency_rounded(amount: str, decimals: str) -> str:
    branches = " ".join(f"WHEN {n} THEN CAST(round({exact(amount)}, {n}) AS DOUBLE)" for n in range(-3, 6))
    return f"CASE {decimals} {branches} ELSE CAST({exact(amount)} AS DOUBLE) END"


def as_of(day: str) -> str:
    return f"(SELECT max(s.snapshot_date) FROM snapshot s WHERE s.snapshot_date <= {day})"


def nights(start: str, end: str, unit: str = "imp_unitario") -> str:
    return f"""CASE WHEN {start} IS NULL OR {end} IS NULL THEN 0 ELSE {unit}
        * CASE ind_tipo_unid WHEN 'N' THEN datediff('day', CAST({start} AS DATE), CAST({end} AS DATE))
                             WHEN 'S' THEN datediff('day', CAST({start} AS DATE), CAST({end} AS DATE)) + 1 ELSE 1 END
        * CASE ind_p_s WHEN 'P' THEN nro_pax ELSE nro_unidades END END"""


_SERVICE_CASE = """CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'hotel' WHEN 'AO' THEN 'circuit' WHEN 'NF' THEN 'other'
    WHEN 'NO' THEN 'transfer' WHEN 'RF' THEN 'endowments' WHEN 'RO' THEN 'extra' END"""

_UNITS = """CAST(l_quantity AS INTEGER) AS nro_unidades, l_linenumber AS nro_pax,
    CASE l_returnflag WHEN 'A' THEN 'N' WHEN 'N' THEN 'S' ELSE 'P' END AS ind_tipo_unid,
    CASE l_linestatus WHEN 'F' THEN 'P' ELSE 'S' END AS ind_p_s,
    CASE WHEN l_quantity = 48 THEN NULL ELSE floor(l_extendedprice) / 100 END AS imp_unitario"""

_END = "CASE WHEN l_quantity = 49 THEN NULL ELSE l_shipdate + to_days(l_linenumber) END"

_NOT_EXCLUDED = "NOT EXISTS (SELECT 1 FROM excluded x WHERE x.seq_rec = {0} AND x.seq_reserva = {1} AND x.ord_extra = {2})"

_TAX_AMOUNTS = f"""coalesce(CASE WHEN ind_tipo_regimen_fac = 'E' THEN {tax_in('imp_margen_canal', 'pct_vta')}
        ELSE {tax_in('imp_venta', 'pct_vta')} - {tax_in('imp_venta - imp_margen_canal', 'pct_cpa')} END, 0) AS sales_tax,
    coalesce(CASE WHEN ind_tipo_regimen_con = 'E' THEN {tax_in('imp_margen_canco', 'pct_vta')}
        ELSE {tax_in('imp_coste + imp_margen_canco', 'pct_vta')} - {tax_in('imp_coste', 'pct_cpa')} END, 0) AS cost_tax"""


def _view(columns: tuple[str, ...]) -> str:
    sums = ", ".join(f"sum(l_extendedprice * {n + 1}) / 1000 AS {name}" for n, name in enumerate(columns))
    return f"""SELECT l_orderkey % {OFFICES} AS grec_seq_rec, l_orderkey AS rres_seq_reserva, {sums}
        FROM lineitem GROUP BY ALL"""


TABLES = {
    "snapshot": "SELECT DISTINCT snapshot_date FROM fx",
    "fx": "SELECT rate_type, CAST(day AS DATE) AS snapshot_date, currency, rate FROM ("
    + _values("rate_type, day, currency, rate", values.FX)
    + ")",
    "tax": _values("ind_tipo_imp, cod_impuesto, cod_clasif, cod_esquema, cod_emp_atlas, pct_impuesto", values.TAX),
    "campaign": _values("cod_campana, cod_interface, ind_rentabilidad", values.CAMPAIGNS),
    "decimals": _values("cod_divisa, decimales", values.DECIMALS),
    "decimals_short": _values("cod_divisa, decimales", values.DECIMALS_WITHOUT_KWD),
    "company_setting": "SELECT * REPLACE (CAST(fec_aplicacion AS DATE) AS fec_aplicacion) FROM ("
    + _values("semp_cod_emp, fec_aplicacion, rex, caj, liq, ctb", values.COMPANY_RATE_TYPES)
    + ")",
    "spread": "SELECT * REPLACE (CAST(fec_aplicacion AS DATE) AS fec_aplicacion) FROM ("
    + _values("tipo_cambio, ori, des, fec_aplicacion, pct_venta, pct_compra, pct_fixing", values.SPREADS)
    + ")",
    "booking": f"""SELECT o_orderkey % {OFFICES} AS operative_incoming, o_orderkey AS booking_id,
        'E' || (o_custkey % 7) AS invoicing_company, CAST(o_orderdate AS DATE) AS creation_date,
        {currency('o_custkey')} AS booking_currency,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(CAST(o_orderdate AS DATE) + 3 AS VARCHAR) ELSE '' END AS modification_date,
        CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) ELSE '' END AS cancellation_date,
        CAST(o_orderdate AS DATE) AS status_date,
        CAST(o_orderdate AS DATE) + 30 AS booking_service_from, CAST(o_orderdate AS DATE) + 37 AS booking_service_to,
        o_totalprice FROM orders""",
    "head": f"""SELECT o_orderkey % {OFFICES} AS grec_seq_rec, o_orderkey AS seq_reserva,
        {currency('o_custkey')} AS gdiv_cod_divisa, o_orderdate AS fec_creacion,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate + INTERVAL 3 DAY END AS fec_modifica,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 10 DAY END AS fec_cancelacion,
        o_orderdate + INTERVAL 30 DAY AS fec_desde, o_orderdate + INTERVAL 37 DAY AS fec_hasta,
        o_custkey AS gtto_seq_ttoo,
        CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % {OFFICES} AS VARCHAR) END AS cod_pais_cliente,
        CAST(o_custkey % 4 + 1 AS INTEGER) AS nro_ad, CAST(o_custkey % 3 AS INTEGER) AS nro_ni,
        'I' || (o_orderkey % 6) AS fint_cod_interface, o_custkey % 30 AS seq_rec_invoicing,
        o_orderpriority || ';' || o_orderkey || ';' AS nom_general, substr(o_orderpriority, 1, 1) AS ind_tipo_credito,
        'D' || (o_custkey % 9) AS gdep_cod_depart, o_orderstatus AS rtre_cod_tipo_res,
        CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END AS ind_facturable_res,
        CASE WHEN o_orderkey % 5 = 0 THEN 'S' ELSE 'N' END AS ind_facturable_adm,
        CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 4 AS DOUBLE) / 2 END AS pct_comision,
        CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 5 AS DOUBLE) / 4 END AS pct_rappel,
        CASE WHEN o_orderstatus = 'O' THEN 'N' ELSE 'S' END AS ind_confirma,
        CASE WHEN o_orderkey % 7 = 0 THEN {currency('o_orderkey')} END AS cod_divisa_p,
        CASE WHEN o_orderkey % 7 = 0 THEN o_custkey END AS seq_ttoo_p,
        CASE WHEN o_orderkey % 7 = 0 THEN o_custkey % 11 END AS cod_suc_p,
        CASE WHEN o_orderkey % 14 = 0 THEN o_custkey % 13 END AS seq_agencia_p,
        CASE WHEN o_orderkey % 14 = 0 THEN o_custkey % 17 END AS seq_sucursal_p,
        CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey % {OFFICES} END AS seq_rec_expediente,
        CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey END AS seq_res_expediente,
        CASE WHEN o_orderkey % 4 = 1 THEN 'H' END AS ind_tippag,
        CASE o_orderkey % 6 WHEN 0 THEN 'E' WHEN 1 THEN NULL ELSE 'C' END AS ind_fec_cam_div FROM orders""",
    "line": f"""SELECT l_orderkey % {OFFICES} AS seq_rec, l_orderkey AS seq_reserva,
        CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber % 2 = 0 THEN 'E' ELSE 'G' END AS ind_tipo_regimen_fac,
        CASE WHEN l_suppkey % 2 = 0 THEN 'E' ELSE 'G' END AS ind_tipo_regimen_con,
        l_extendedprice AS imp_venta, l_extendedprice * (1 - l_discount) AS imp_coste,
        CASE WHEN l_quantity = 50 THEN NULL ELSE l_extendedprice * l_discount END AS imp_margen_canal,
        l_extendedprice * l_discount * CAST(0.5 AS DOUBLE) AS imp_margen_canco,
        CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS cod_impuesto_vta_fac,
        CASE WHEN l_returnflag || l_linestatus = 'RO' THEN CAST(l_linenumber AS BIGINT) END AS ord_extra,
        {_SERVICE_CASE} AS service_type FROM lineitem""",
    "taxed": f"""SELECT l.*, vta.pct_impuesto AS pct_vta, cpa.pct_impuesto AS pct_cpa FROM line l
        JOIN tax vta ON vta.ind_tipo_imp = 'I' AND vta.cod_impuesto = l.cod_impuesto_vta_fac AND vta.cod_clasif = 'C'
            AND vta.cod_esquema = 'S' AND vta.cod_emp_atlas = 'E'
        JOIN tax cpa ON cpa.ind_tipo_imp = 'I' AND cpa.cod_impuesto = l.cod_impuesto_vta_fac AND cpa.cod_clasif = 'C'
            AND cpa.cod_esquema = 'S' AND cpa.cod_emp_atlas = 'E'""",
    "taxed_any_type": """SELECT l.*, vta.pct_impuesto AS pct_vta, cpa.pct_impuesto AS pct_cpa FROM line l
        JOIN tax vta ON vta.cod_impuesto = l.cod_impuesto_vta_fac AND vta.cod_clasif = 'C'
            AND vta.cod_esquema = 'S' AND vta.cod_emp_atlas = 'E'
        JOIN tax cpa ON cpa.ind_tipo_imp = 'I' AND cpa.cod_impuesto = l.cod_impuesto_vta_fac AND cpa.cod_clasif = 'C'
            AND cpa.cod_esquema = 'S' AND cpa.cod_emp_atlas = 'E'""",
    "extra_bond": f"""SELECT l_orderkey % {OFFICES} AS grec_seq_rec, l_orderkey AS rres_seq_reserva,
        CAST(l_linenumber AS BIGINT) AS ord_extra, l_partkey AS num_bono, 'I' || (l_suppkey % 2) AS cod_interface
        FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'""",
    "bond": "SELECT p_partkey AS num_bono, 'I' || (p_partkey % 2) AS cod_interface, p_type AS cod_campana FROM part",
    "excluded": """SELECT DISTINCT e.grec_seq_rec AS seq_rec, e.rres_seq_reserva AS seq_reserva, e.ord_extra
        FROM extra_bond e JOIN bond b ON b.num_bono = e.num_bono AND b.cod_interface = e.cod_interface
        JOIN campaign c ON c.cod_campana = b.cod_campana AND c.cod_interface = b.cod_interface
        WHERE c.ind_rentabilidad = 'N'""",
    "kept_line": "SELECT t.*, " + _TAX_AMOUNTS + " FROM taxed t WHERE " + _NOT_EXCLUDED.format("t.seq_rec", "t.seq_reserva", "t.ord_extra"),
    "priced": f"""SELECT b.*, f.rate AS booking_rate, e.rate AS eur_rate
        FROM (SELECT *, {as_of('creation_date')} AS snapshot_date FROM booking) b
        LEFT JOIN fx f ON f.rate_type = 'M' AND f.snapshot_date = b.snapshot_date AND f.currency = b.booking_currency
        LEFT JOIN fx e ON e.rate_type = 'M' AND e.snapshot_date = b.snapshot_date AND e.currency = 'EUR'""",
    "cost": f"""SELECT l_orderkey % {OFFICES} AS grec_seq_rec, l_orderkey AS rres_seq_reserva,
        CAST(l_linenumber AS BIGINT) AS rext_ord_extra, {currency('l_suppkey')} AS sdiv_cod_divisa,
        l_shipdate AS fec_desde, {_END} AS fec_hasta, {_UNITS},
        CASE WHEN l_tax = 0 THEN 'BT' ELSE 'DR' END AS ind_tipo_registro,
        CASE WHEN l_discount = 0 THEN 'N' ELSE 'S' END AS ind_facturable FROM lineitem""",
    "kept_cost": f"""SELECT c.*, {nights('fec_desde', 'fec_hasta')} AS nights FROM cost c
        WHERE ind_tipo_registro = 'DR' AND ind_facturable = 'S'
        AND {_NOT_EXCLUDED.format('c.grec_seq_rec', 'c.rres_seq_reserva', 'c.rext_ord_extra')}""",
    "priced_cost": """SELECT c.*, p.booking_rate, p.eur_rate, f.rate AS line_rate FROM kept_cost c
        JOIN priced p ON p.operative_incoming = c.grec_seq_rec AND p.booking_id = c.rres_seq_reserva
        LEFT JOIN fx f ON f.rate_type = 'M' AND f.snapshot_date = p.snapshot_date AND f.currency = c.sdiv_cod_divisa""",
    "cost_sum": """SELECT grec_seq_rec, rres_seq_reserva, coalesce(sum(nights * line_rate / booking_rate), 0) AS cost_field,
        CAST(coalesce(sum(round(CAST(nights * line_rate / eur_rate AS DECIMAL(28,6)), 3)), 0) AS DOUBLE) AS cost_field_eur,
        CAST(count(nights) FILTER (line_rate IS NULL OR booking_rate IS NULL) AS BIGINT) AS unconverted,
        CAST(count(nights) FILTER (line_rate IS NULL OR eur_rate IS NULL) AS BIGINT) AS unconverted_eur
        FROM priced_cost GROUP BY ALL""",
    "tax_sum": """SELECT k.seq_rec, k.seq_reserva, sum(sales_tax) AS sales_tax, sum(cost_tax) AS cost_tax,
        sum(sales_tax) + sum(coalesce(cost_tax * booking_rate / eur_rate, 0)) AS transfer_tax,
        CAST(sum(coalesce(round(CAST(sales_tax * booking_rate / eur_rate AS DECIMAL(28,6)), 3), 0)) AS DOUBLE) AS sales_tax_eur,
        CAST(sum(coalesce(round(CAST(cost_tax * booking_rate / eur_rate AS DECIMAL(28,6)), 3), 0)) AS DOUBLE) AS cost_tax_eur
        FROM kept_line k JOIN priced p ON p.operative_incoming = k.seq_rec AND p.booking_id = k.seq_reserva GROUP BY ALL""",
    "totals": """SELECT p.*, coalesce(t.sales_tax, 0) AS sales_total,
        coalesce(t.cost_tax, 0) + coalesce(c.cost_field, 0) AS cost_total,
        coalesce(t.transfer_tax, 0) + coalesce(c.cost_field, 0) AS transfer_total,
        coalesce(t.sales_tax_eur, 0) AS sales_line_eur,
        coalesce(t.cost_tax_eur, 0) + coalesce(c.cost_field_eur, 0) AS cost_line_eur,
        coalesce(t.sales_tax_eur + t.cost_tax_eur, 0) + coalesce(c.cost_field_eur, 0) AS transfer_line_eur
        FROM priced p LEFT JOIN tax_sum t ON t.seq_rec = p.operative_incoming AND t.seq_reserva = p.booking_id
        LEFT JOIN cost_sum c ON c.grec_seq_rec = p.operative_incoming AND c.rres_seq_reserva = p.booking_id""",
    "measure": f"""SELECT t.*, {currency_rounded('sales_total', 'd.decimales')} AS tax_sales_transfer_pricing,
        {currency_rounded('cost_total', 'd.decimales')} AS tax_cost_transfer_pricing,
        {currency_rounded('transfer_total', 'd.decimales')} AS transfer_pricing
        FROM totals t LEFT JOIN decimals d ON d.cod_divisa = t.booking_currency""",
    "measure_eur": "SELECT *, "
    + ", ".join(
        f"coalesce({money(f'{name} * booking_rate / eur_rate', 3)}, 0) AS {out}"
        for name, out in (
            ("tax_sales_transfer_pricing", "tax_sales_transfer_pricing_eur"),
            ("tax_cost_transfer_pricing", "tax_cost_transfer_pricing_eur"),
            ("transfer_pricing", "tax_transfer_pricing_eur"),
        )
    )
    + " FROM measure",
    "sale": f"""SELECT l_orderkey % {OFFICES} AS grec_seq_rec_s, l_orderkey AS rres_seq_reserva,
        l_shipdate AS fec_desde_s, {_END} AS fec_hasta_s, {_UNITS},
        coalesce((['O', 'V', 'D', 'W', 'Y', 'IT', 'CH', 'BT'])[CAST(round(l_discount * 100) AS INTEGER) + 1], 'H') AS ind_tipo_registro,
        CASE WHEN l_partkey % 4 = 0 THEN 'N' ELSE 'S' END AS ind_facturable,
        CASE WHEN l_partkey % 9 = 0 THEN 'S' ELSE 'N' END AS ind_contra_apunte,
        CASE WHEN l_suppkey % 2 = 0 THEN l_extendedprice * l_tax END AS imp_impuesto,
        CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber % 2 = 0 THEN 'E' ELSE 'G' END AS ind_tipo_regimen,
        CASE l_suppkey % 3 WHEN 1 THEN 'N' WHEN 2 THEN 'S' END AS ind_trfprc,
        CASE WHEN l_quantity = 47 THEN '99' ELSE CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) END AS rvp_cod_impuesto
        FROM lineitem""",
    "charged_sale": """SELECT s.*, h.ind_tippag, h.ind_fec_cam_div, h.fec_creacion, h.fec_desde FROM sale s
        JOIN head h ON h.grec_seq_rec = s.grec_seq_rec_s AND h.seq_reserva = s.rres_seq_reserva
        WHERE (h.ind_tippag IS NULL AND s.ind_facturable = 'S') OR (h.ind_tippag IS NOT NULL AND s.ind_tipo_registro <> 'CH')""",
    "sale_tax": f"""SELECT s.*, ind_tipo_regimen || coalesce(ind_trfprc, 'N') AS regime,
        CASE WHEN ind_tipo_registro = 'BT' THEN 0 ELSE coalesce(imp_impuesto,
            {nights('fec_desde_s', 'fec_hasta_s', '(imp_unitario - imp_unitario / (1 + t.pct_impuesto / 100))')}) END AS line_tax
        FROM charged_sale s LEFT JOIN tax t ON t.ind_tipo_imp = 'I' AND t.cod_impuesto = s.rvp_cod_impuesto
            AND t.cod_esquema = 'S' AND t.cod_clasif = 'C' AND t.cod_emp_atlas = 'E'
        WHERE ind_tipo_registro NOT IN ('O', 'D', 'IT') AND ind_contra_apunte = 'N'""",
    "info": f"""SELECT user_id % {OFFICES} AS seq_rec, user_id AS seq_reserva, ts AS fec_creacion,
        CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'A' ELSE 'B' END AS tipo_op, event_type AS aplicacion FROM events""",
    "hotel_sale": f"""SELECT l_orderkey % {OFFICES} AS grec_seq_rec, l_orderkey AS seq_reserva, l_suppkey AS ghor_seq_hotel,
        CASE WHEN l_discount >= 0.05 THEN l_shipdate END AS fec_cancelacion FROM lineitem
        WHERE l_returnflag = 'A' AND l_linestatus = 'F'""",
    "destination": """SELECT 'D' || n_nationkey AS code, n_name AS nom_destino, 'ENG' AS language FROM nation
        UNION ALL SELECT 'D' || n_nationkey, n_name || '_ES', 'SPA' FROM nation""",
    "hotel_place": """SELECT s.grec_seq_rec, s.seq_reserva, s.ghor_seq_hotel, d.code AS izge_cod_destino, d.nom_destino
        FROM hotel_sale s JOIN supplier h ON h.s_suppkey = s.ghor_seq_hotel
        JOIN destination d ON d.code = 'D' || h.s_nationkey AND d.language = 'ENG'""",
    "other_service": f"""SELECT l_orderkey % {OFFICES} AS seq_rec, l_orderkey AS seq_reserva, 'CT' || l_partkey AS nom_contrato,
        'T' || (l_partkey % 3) AS ind_tipo_otro, CAST(l_shipdate AS DATE) AS fec_desde FROM lineitem
        WHERE l_returnflag = 'N' AND l_linestatus = 'F'""",
    "contract": f"""SELECT CAST(o.office AS BIGINT) AS seq_rec, 'CT' || p_partkey AS nom_contrato, 'T' || (p_partkey % 3) AS ind_tipo_otro,
        t.starts AS fec_desde, t.ends AS fec_hasta, 'D' || ((p_partkey + t.term) % 30) AS cod_destino
        FROM part JOIN range({OFFICES}) o(office) ON o.office % 5 = p_partkey % 5,
        (VALUES (0, DATE '1995-01-01', DATE '1997-12-31'), (1, DATE '1997-07-01', DATE '2000-06-30')) t(term, starts, ends)""",
    "contract_place": """SELECT o.seq_rec AS grec_seq_rec, o.seq_reserva, o.nom_contrato, c.fec_desde AS contract_from, c.cod_destino,
        d.nom_destino AS nom_destino2 FROM other_service o
        JOIN contract c ON c.seq_rec = o.seq_rec AND c.nom_contrato = o.nom_contrato AND c.ind_tipo_otro = o.ind_tipo_otro
            AND o.fec_desde BETWEEN c.fec_desde AND c.fec_hasta
        JOIN destination d ON d.code = c.cod_destino AND d.language = 'ENG'""",
    "hotel_first": """SELECT grec_seq_rec, seq_reserva, izge_cod_destino, nom_destino FROM hotel_place QUALIFY
        row_number() OVER (PARTITION BY grec_seq_rec, seq_reserva ORDER BY ghor_seq_hotel, izge_cod_destino) = 1""",
    "contract_first": """SELECT grec_seq_rec, seq_reserva, cod_destino, nom_destino2 FROM contract_place QUALIFY row_number() OVER
        (PARTITION BY grec_seq_rec, seq_reserva ORDER BY nom_contrato, contract_from, cod_destino) = 1""",
    "application": """SELECT seq_rec AS grec_seq_rec, seq_reserva, aplicacion FROM info WHERE tipo_op = 'A' QUALIFY row_number() OVER
        (PARTITION BY seq_rec, seq_reserva ORDER BY fec_creacion, aplicacion) = 1""",
    "resale": f"""SELECT o_orderkey % {OFFICES} AS seq_rec, o_orderkey AS seq_reserva, CASE WHEN o_orderkey % 10 = 4 THEN 'ZZ'
        WHEN o_orderstatus = 'P' THEN 'RR' WHEN o_orderstatus = 'O' THEN 'CN' ELSE 'RL' END AS ind_status
        FROM orders WHERE o_orderkey % 2 = 0""",
    "day_rate": f"""SELECT d.date, f.currency, f.rate / e.rate AS rate
        FROM (SELECT date, {as_of('date')} AS snapshot_date FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)) d
        JOIN fx f ON f.rate_type = 'M' AND f.snapshot_date = d.snapshot_date
        LEFT JOIN fx e ON e.rate_type = 'M' AND e.snapshot_date = d.snapshot_date AND e.currency = 'EUR'""",
    "receptive": """SELECT CAST(n_nationkey AS BIGINT) AS seq_rec, 'C' || n_regionkey AS semp_cod_emp, 'O' || n_nationkey AS sofi_cod_ofi,
        n_name AS des_receptivo FROM nation""",
    "interface": """SELECT 'I' || r_regionkey AS cod_interface, CASE WHEN r_regionkey IN (1, 3) THEN NULL ELSE r_name END AS partner_ttoo
        FROM region""",
    "sold": """SELECT h.*, c.c_name AS nom_corto_ttoo, CAST(c.c_nationkey AS VARCHAR) AS gpai_cod_pais_mercado,
        CAST(n.n_nationkey AS VARCHAR) AS source_market, 'X' || n.n_nationkey AS source_market_iso
        FROM head h JOIN customer c ON c.c_custkey = h.gtto_seq_ttoo
        JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = coalesce(h.cod_pais_cliente, CAST(c.c_nationkey AS VARCHAR))""",
    "dimensioned": """SELECT s.*, re.semp_cod_emp AS semp_cod_emp_re, re.sofi_cod_ofi AS sofi_cod_ofi_re, re.des_receptivo AS des_receptivo_re,
        rf.seq_rec AS seq_rec_rf, rf.semp_cod_emp AS semp_cod_emp_rf, rf.sofi_cod_ofi AS sofi_cod_ofi_rf, i.partner_ttoo
        FROM sold s LEFT JOIN receptive re ON re.seq_rec = s.grec_seq_rec
        LEFT JOIN receptive rf ON rf.seq_rec = s.seq_rec_invoicing
        LEFT JOIN interface i ON i.cod_interface = s.fint_cod_interface""",
    "partner_quote": f"""SELECT c_custkey AS seq_ttoo, d.fec_desde,
        CASE w.way WHEN 'out' THEN {currency('c_custkey')} ELSE 'EUR' END AS ori,
        CASE w.way WHEN 'out' THEN 'EUR' ELSE {currency('c_custkey')} END AS des,
        CASE w.way WHEN 'out' THEN 0.5::DOUBLE + CAST(c_custkey % 7 AS DOUBLE) / 8
            ELSE 2.0::DOUBLE + CAST(year(d.fec_desde) % 4 AS DOUBLE) / 4 END AS nro_tasa
        FROM customer, (VALUES (DATE '1995-06-01'), (DATE '1998-06-01'), (DATE '2000-01-01')) d(fec_desde), (VALUES ('out'), ('in')) w(way)
        WHERE {currency('c_custkey')} <> 'EUR'
        AND ((w.way = 'out' AND c_custkey % 2 = 0) OR (w.way = 'in' AND c_custkey % 4 <> 0))""",
    "sale_view": _view(SALE_MEASURES),
    "cost_view": _view(COST_MEASURES),
    "fee_view": _view(FEE_MEASURES),
}

_CANREC = """CASE CASE ind_status WHEN 'RR' THEN 'R' WHEN 'CN' THEN 'RL'
        WHEN 'RL' THEN CASE WHEN fec_cancelacion IS NULL THEN 'RS' ELSE 'C' END ELSE ind_status END
    WHEN 'RS' THEN 'Reventa' WHEN 'C' THEN 'Cancelada' WHEN 'RL' THEN 'Liberada' WHEN 'R' THEN 'Reventa' END"""

_DAY_OR_EMPTY = "coalesce(strftime({0}, '%Y-%m-%d'), '')"
_SECOND_OR_EMPTY = "coalesce(strftime({0}, '%Y-%m-%d %H:%M:%S'), '')"

_BOOKING_FIELDS = """operative_incoming, booking_id, invoicing_company, creation_date, booking_currency, modification_date,
    cancellation_date, status_date, booking_service_from, booking_service_to"""

_MIDNIGHTS = """operative_incoming, booking_id, invoicing_company, booking_currency, CAST(creation_date AS TIMESTAMP) AS creation_date,
    CAST(nullif(modification_date, '') AS TIMESTAMP) AS modification_date,
    CAST(nullif(cancellation_date, '') AS TIMESTAMP) AS cancellation_date, CAST(status_date AS TIMESTAMP) AS status_date,
    CAST(booking_service_from AS TIMESTAMP) AS booking_service_from, CAST(booking_service_to AS TIMESTAMP) AS booking_service_to"""

_ALL_MEASURES = """tax_sales_transfer_pricing, tax_sales_transfer_pricing_eur, tax_cost_transfer_pricing,
    tax_cost_transfer_pricing_eur, transfer_pricing, tax_transfer_pricing_eur"""


def _wide() -> str:
    from stayledger.plans.wide import BOOKING_CURRENCY_MEASURES, EUR_MEASURES, UNSUPPLIED

    twins = ", ".join(
        f"{money(f'coalesce({source}, 0)', 2)} AS {name}, {money(f'coalesce({source}, 0) * coalesce(day_rate, 0)', 2)} AS {eur}"
        for name, eur, source in BOOKING_CURRENCY_MEASURES
    )
    euros = ", ".join(f"{money(f'coalesce({source}, 0)', 2)} AS {name}" for name, source in EUR_MEASURES)
    zeros = ", ".join(f"0 AS {name}" for name in UNSUPPLIED)
    return f"""SELECT grec_seq_rec, seq_reserva, gdiv_cod_divisa, fec_creacion, semp_cod_emp_rf,
        grec_seq_rec || '-' || seq_reserva AS interface_id, semp_cod_emp_re AS operative_company, sofi_cod_ofi_re AS operative_office,
        des_receptivo_re AS operative_office_desc, grec_seq_rec AS operative_incoming, seq_reserva AS booking_id,
        fint_cod_interface AS interface, semp_cod_emp_rf AS invoicing_company, sofi_cod_ofi_rf AS invoicing_office,
        seq_rec_rf AS invoicing_incoming, CAST(fec_creacion AS DATE) AS creation_date, fec_creacion AS creation_ts, first_booking_ts,
        {_DAY_OR_EMPTY.format('fec_modifica')} AS modification_date, {_SECOND_OR_EMPTY.format('fec_modifica')} AS modification_ts,
        {_DAY_OR_EMPTY.format('fec_cancelacion')} AS cancellation_date, {_SECOND_OR_EMPTY.format('fec_cancelacion')} AS cancellation_ts,
        CASE WHEN fec_cancelacion IS NULL THEN 'N' ELSE 'S' END AS cancelled_booking,
        CAST(greatest(fec_creacion, fec_modifica, fec_cancelacion) AS DATE) AS status_date,
        CAST(fec_desde AS DATE) AS booking_service_from, CAST(fec_hasta AS DATE) AS booking_service_to,
        gtto_seq_ttoo AS client_code, nom_corto_ttoo AS customer_name, source_market, source_market_iso,
        replace(nom_general, ';', '') AS holder, ind_tipo_credito AS credit_type, nro_ad AS num_adults, nro_ni AS num_childrens,
        gdep_cod_depart AS department_code, rtre_cod_tipo_res AS booking_type, ind_facturable_res AS invoicing_booking,
        ind_facturable_adm AS invoicing_admin, {money('coalesce(pct_comision, 0)', 2)} AS client_commision_esp,
        {money('coalesce(pct_rappel, 0)', 2)} AS client_override_esp, ind_confirma AS confirmed_booking,
        CASE WHEN partner_ttoo IS NULL THEN 'N' ELSE 'S' END AS Partner_booking, coalesce(cod_divisa_p, '') AS Partner_booking_currency,
        coalesce(seq_ttoo_p, 0) AS Partner_code, coalesce(cod_suc_p, 0) AS Partner_brand, coalesce(seq_agencia_p, 0) AS Partner_agency_code,
        coalesce(seq_sucursal_p, 0) AS Partner_agency_brand, coalesce(seq_rec_expediente, 0) AS Booking_file_incoming,
        coalesce(seq_res_expediente, 0) AS booking_file_number,
        CASE WHEN ind_tippag IS NULL THEN 'Merchant' ELSE 'Pago en hotel' END AS Accomodation_model,
        coalesce(izge_cod_destino || '-' || nom_destino, cod_destino || '-' || nom_destino2, 'NO_DESTINATION_CODE') AS Destination_code,
        gdiv_cod_divisa AS booking_currency, aplicacion AS Application, {_CANREC} AS canrec_status,
        coalesce(act_services, 0) AS NUMBER_ACTIVE_ACC_SERV, {twins}, {euros}, {zeros}
        FROM (SELECT d.*, r.rate AS day_rate, v.ind_status, a.aplicacion, i.first_booking_ts, s.act_services,
                h.izge_cod_destino, h.nom_destino, c.cod_destino, c.nom_destino2,
                m.* EXCLUDE (grec_seq_rec, rres_seq_reserva), n.* EXCLUDE (grec_seq_rec, rres_seq_reserva),
                o.* EXCLUDE (grec_seq_rec, rres_seq_reserva)
            FROM dimensioned d
            LEFT JOIN day_rate r ON r.date = CAST(d.fec_creacion AS DATE) AND r.currency = d.gdiv_cod_divisa
            LEFT JOIN resale v ON v.seq_rec = d.grec_seq_rec AND v.seq_reserva = d.seq_reserva
            LEFT JOIN application a ON a.grec_seq_rec = d.grec_seq_rec AND a.seq_reserva = d.seq_reserva
            LEFT JOIN (SELECT seq_rec, seq_reserva, min(fec_creacion) AS first_booking_ts FROM info WHERE tipo_op = 'A' GROUP BY ALL) i
                ON i.seq_rec = d.grec_seq_rec AND i.seq_reserva = d.seq_reserva
            LEFT JOIN (SELECT grec_seq_rec, seq_reserva, count(*) AS act_services FROM hotel_sale WHERE fec_cancelacion IS NULL GROUP BY ALL) s
                ON s.grec_seq_rec = d.grec_seq_rec AND s.seq_reserva = d.seq_reserva
            LEFT JOIN hotel_first h ON h.grec_seq_rec = d.grec_seq_rec AND h.seq_reserva = d.seq_reserva
            LEFT JOIN contract_first c ON c.grec_seq_rec = d.grec_seq_rec AND c.seq_reserva = d.seq_reserva
            LEFT JOIN sale_view m ON m.grec_seq_rec || '-' || m.rres_seq_reserva = d.grec_seq_rec || '-' || d.seq_reserva
            LEFT JOIN cost_view n ON n.grec_seq_rec || '-' || n.rres_seq_reserva = d.grec_seq_rec || '-' || d.seq_reserva
            LEFT JOIN fee_view o ON o.grec_seq_rec || '-' || o.rres_seq_reserva = d.grec_seq_rec || '-' || d.seq_reserva)
        WHERE fec_creacion BETWEEN TIMESTAMP '{WIDE_RANGE[0]}' AND TIMESTAMP '{WIDE_RANGE[1]}' AND seq_reserva > 0"""


def _header() -> str:
    from stayledger.operators.header import CARRIED, PLAIN_FIELDS

    carried = ", ".join(CARRIED)
    renamed = ", ".join(f"{source} AS {name}" for name, source in PLAIN_FIELDS)
    return f"""SELECT {carried}, {renamed}, grec_seq_rec || '-' || seq_reserva AS interface_id,
        strftime(fec_creacion, '%Y-%m-%d') AS Creation_date, strftime(fec_modifica, '%Y-%m-%d') AS modification_date,
        strftime(fec_cancelacion, '%Y-%m-%d') AS cancellation_date,
        strftime(greatest(fec_creacion, fec_modifica, fec_cancelacion), '%Y-%m-%d') AS status_date,
        replace(nom_general, ';', '') AS Holder, CASE WHEN fec_cancelacion IS NULL THEN 'N' ELSE 'S' END AS cancelled_booking,
        CASE WHEN partner_ttoo IS NULL THEN 'N' ELSE 'S' END AS Partner_booking,
        CASE WHEN ind_tippag IS NULL THEN 'Merchant' ELSE 'Pago en hotel' END AS Accomodation_model FROM dimensioned"""


def _percents(table: str) -> str:
    return f"""SELECT seq_rec, seq_reserva, cod_impuesto_vta_fac, pct_vta, pct_cpa, {money('imp_venta')} AS imp_venta FROM {table}"""


def _measure(column: str) -> str:
    return f"SELECT operative_incoming, booking_id, booking_currency, {column} FROM measure_eur"


def _tax_of(regime: str, out: str) -> str:
    return f"""SELECT h.grec_seq_rec, h.seq_reserva, {money(f"coalesce(sum(CASE WHEN s.regime = '{regime}' THEN s.line_tax ELSE 0 END), 0)")} AS {out}
        FROM head h LEFT JOIN sale_tax s ON s.grec_seq_rec_s = h.grec_seq_rec AND s.rres_seq_reserva = h.seq_reserva GROUP BY ALL"""


_VIEW_MEASURES = ", ".join(
    f"{money(f'coalesce({name}, 0)')} AS {name}" for name in (*SALE_MEASURES, *COST_MEASURES, *FEE_MEASURES)
)

def _purchase(since: str) -> str:
    return f"""SELECT e.event_id, e.user_id, b.bought_at, b.bought_value FROM events e
        ASOF LEFT JOIN (SELECT user_id, ts AS bought_at, max(value) AS bought_value FROM events WHERE event_type = 'purchase' GROUP BY ALL) b
        ON e.user_id = b.user_id AND e.ts {since} b.bought_at"""


def _key_rules(table: str, source: str, *key: str) -> str:
    missing = " OR ".join(f"{column} IS NULL" for column in key)
    counted = f"(SELECT {missing} AS missing, count(*) AS n FROM {source} GROUP BY {', '.join(key)})"
    return f"""SELECT '{table}' AS table_name, 'repeated key' AS rule,
            CAST(coalesce(sum(n - 1) FILTER (NOT missing), 0) AS BIGINT) AS rows, CAST(0 AS DOUBLE) AS amount FROM {counted}
        UNION ALL SELECT '{table}', 'key missing', CAST(coalesce(sum(n) FILTER (missing), 0) AS BIGINT), CAST(0 AS DOUBLE) FROM {counted}"""


def _line_rules(table: str, source: str, office: str, booking: str, amount: str, **needs: str) -> str:
    """``needs`` maps rules (with _ for blanks) to conditions, tested in order before that of the booking."""
    tests = {rule.replace("_", " "): condition for rule, condition in needs.items()}
    tests["no booking"] = f"EXISTS (SELECT 1 FROM booking WHERE operative_incoming = s.{office} AND booking_id = s.{booking})"
    branches = " ".join(f"WHEN NOT {condition} THEN '{rule}'" for rule, condition in tests.items())
    judged = f"(SELECT CASE {branches} ELSE 'lines summed' END AS reason, {exact(amount)} AS amount FROM {source} s)"
    total = f"CAST(count(*) FILTER ({{0}}) AS BIGINT), coalesce({money('sum(amount) FILTER ({0})', 2)}, 0)"
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, {total.format(held)} FROM {judged}"
        for rule, held in {"lines read": "TRUE", **{rule: f"reason = '{rule}'" for rule in ("lines summed", *tests)}}.items()
    )


def _contract() -> str:
    taxed = "EXISTS (SELECT 1 FROM tax t WHERE t.ind_tipo_imp = 'I' AND t.cod_clasif = 'C' AND t.cod_esquema = 'S' AND t.cod_emp_atlas = 'E' AND t.cod_impuesto = s.{0})"
    service = taxed.format("cod_impuesto_vta_fac")
    return " UNION ALL ".join(
        (
            _key_rules("tax", "tax", "ind_tipo_imp", "cod_impuesto", "cod_clasif", "cod_esquema", "cod_emp_atlas"),
            _key_rules("tax_any_type", "tax", "cod_impuesto", "cod_clasif", "cod_esquema", "cod_emp_atlas"),
            _key_rules("currency", "decimals", "cod_divisa"),
            _key_rules("booking_interface", "booking", "operative_incoming", "booking_id"),
            _key_rules("booking", "head", "grec_seq_rec", "seq_reserva"),
            _key_rules("resale", f"(SELECT o_orderkey % {OFFICES} AS seq_rec, o_orderkey FROM orders WHERE o_orderkey % 2 = 0)", "seq_rec", "o_orderkey"),
            _key_rules("tour_operator", "customer", "c_custkey"),
            _key_rules("country", "nation", "n_nationkey"),
            _key_rules("receptive", "nation", "n_nationkey"),
            _key_rules("interface", "region", "r_regionkey"),
            _key_rules("market_of_customer", "head", "cod_pais_cliente"),
            _key_rules("hotel_master", "supplier", "s_suppkey"),
            _line_rules("service", "line", "seq_rec", "seq_reserva", "imp_venta", no_sales_tax_row=service, no_purchase_tax_row=service),
            _line_rules("cost", "cost", "grec_seq_rec", "rres_seq_reserva", "imp_unitario"),
            _line_rules("sale", "sale", "grec_seq_rec_s", "rres_seq_reserva", "imp_unitario", no_sales_tax_row=taxed.format("rvp_cod_impuesto")),
            _line_rules("booking_information", "info", "seq_rec", "seq_reserva", "1"),
        )
    )


STATEMENTS = {
    "regime_decode": f"""SELECT seq_rec, seq_reserva, ind_tipo_regimen_fac,
        {money("CASE WHEN ind_tipo_regimen_fac = 'E' THEN imp_margen_canal ELSE imp_venta END")} AS base,
        CASE WHEN ind_tipo_regimen_fac IS NULL THEN 'unset' ELSE 'set' END AS regime_given FROM line""",
    "tax_component": f"""SELECT seq_rec, seq_reserva, cod_impuesto_vta_fac, {money(tax_in('imp_venta', 'pct_vta'))} AS venta_tax,
        {money(tax_in('imp_coste', 'pct_cpa'))} AS coste_tax,
        {money(f"CASE WHEN ind_tipo_regimen_con = 'E' THEN {tax_in('imp_margen_canco', 'pct_vta')} ELSE 0 END")} AS margin_tax FROM taxed""",
    "night_amount": f"""SELECT grec_seq_rec, rres_seq_reserva, rext_ord_extra, {money(nights('fec_desde', 'fec_hasta'))} AS nights,
        {money("""CASE WHEN fec_desde IS NULL OR fec_hasta IS NULL THEN 0 WHEN rext_ord_extra % 3 = 0
            THEN imp_unitario * nro_pax * CASE ind_p_s WHEN 'P' THEN nro_pax ELSE nro_unidades END ELSE """
            + nights('fec_desde', 'fec_hasta') + " END")} AS stated_days FROM cost""",
    "round_half_up": f"""SELECT l_orderkey, l_linenumber, {money('l_extendedprice / 2', 0)} AS units, {money('l_extendedprice / 2', 2)} AS cents,
        {money('-(l_extendedprice / 2)', 2)} AS credit_cents FROM lineitem""",
    "round_by_currency": f"""SELECT booking_id AS o_orderkey, booking_currency, {currency_rounded('o_totalprice / 8', 'd.decimales')} AS amount,
        {currency_rounded('o_totalprice / 8', 's.decimales')} AS amount_kwd_unknown FROM booking
        LEFT JOIN decimals d ON d.cod_divisa = booking_currency LEFT JOIN decimals_short s ON s.cod_divisa = booking_currency""",
    "dates_to_midnight": f"SELECT {_MIDNIGHTS} FROM booking",
    "header_dates": f"""SELECT seq_reserva, CAST(fec_creacion AS DATE) AS creation_date, strftime(fec_creacion, '%Y-%m-%d') AS creation_day,
        strftime(fec_creacion, '%Y-%m-%d %H:%M:%S') AS creation_second, {_DAY_OR_EMPTY.format('fec_modifica')} AS modification_date,
        {_SECOND_OR_EMPTY.format('fec_cancelacion')} AS cancellation_ts, CAST(fec_desde AS DATE) AS booking_service_from FROM head""",
    "status_date": "SELECT seq_reserva, CAST(greatest(fec_creacion, fec_modifica, fec_cancelacion) AS DATE) AS status_date FROM head",
    "interface_id": """SELECT seq_reserva, grec_seq_rec || '-' || seq_reserva AS interface_id,
        seq_rec_expediente || '-' || seq_res_expediente AS file_id FROM head""",
    "holder_clean": "SELECT seq_reserva, replace(nom_general, ';', '') AS holder FROM head",
    "booking_flags": """SELECT seq_reserva, CASE WHEN fec_cancelacion IS NULL THEN 'N' ELSE 'S' END AS cancelled_booking,
        CASE WHEN partner_ttoo IS NULL THEN 'N' ELSE 'S' END AS partner_booking,
        CASE WHEN ind_tippag IS NULL THEN 'Merchant' ELSE 'Pago en hotel' END AS accomodation_model
        FROM head LEFT JOIN interface ON cod_interface = fint_cod_interface""",
    "resale_status": f"""SELECT h.seq_reserva, {_CANREC} AS canrec_status FROM head h
        LEFT JOIN resale r ON r.seq_rec = h.grec_seq_rec AND r.seq_reserva = h.seq_reserva""",
    "exchange_date": """SELECT seq_reserva, CAST(CASE WHEN ind_fec_cam_div = 'E' THEN fec_desde ELSE fec_creacion END AS DATE)
        AS date_ccy_exchange FROM head""",
    "daily_extract": f"SELECT {_BOOKING_FIELDS} FROM booking WHERE creation_date = DATE '{RUN_DATE}'",
    "daily_extract_top_n": f"SELECT {_BOOKING_FIELDS} FROM booking ORDER BY operative_incoming, booking_id LIMIT {TOP}",
    "drop_measures": f"SELECT {_BOOKING_FIELDS} FROM booking",
    "header_range_filter": f"""SELECT grec_seq_rec, seq_reserva, fec_creacion FROM head
        WHERE fec_creacion BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}' AND seq_reserva > 0""",
    "cost_lines_billable": f"""SELECT grec_seq_rec, rres_seq_reserva, rext_ord_extra, {money('imp_unitario')} AS imp_unitario FROM cost
        WHERE ind_tipo_registro = 'DR' AND ind_facturable = 'S'""",
    "booking_key_semi": """SELECT grec_seq_rec, rres_seq_reserva, rext_ord_extra, nro_unidades FROM cost
        WHERE EXISTS (SELECT 1 FROM booking b WHERE b.operative_incoming = grec_seq_rec AND b.booking_id = rres_seq_reserva
            AND b.creation_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31')""",
    "sale_type_not_in": """SELECT grec_seq_rec_s, rres_seq_reserva, ind_tipo_registro, nro_unidades FROM sale
        WHERE ind_tipo_registro NOT IN ('O', 'V', 'D', 'W', 'Y', 'IT') AND ind_contra_apunte = 'N'""",
    "sale_payment_model_filter": """SELECT grec_seq_rec_s, rres_seq_reserva, ind_tippag, ind_tipo_registro, ind_facturable, nro_unidades
        FROM charged_sale""",
    "service_lines_in_scope": f"""SELECT seq_rec, seq_reserva, service_type, booking_currency, creation_date, {money('imp_venta')} AS imp_venta
        FROM line JOIN booking ON operative_incoming = seq_rec AND booking_id = seq_reserva""",
    "tax_join_four_key": _percents("taxed_any_type"),
    "tax_join_five_key": _percents("taxed"),
    "left_join_measures": f"""SELECT operative_incoming, booking_id, booking_currency, {money('coalesce(sum(sales_tax), 0)')} AS sales_tax,
        {money('coalesce(sum(cost_tax), 0)')} AS cost_tax FROM booking
        LEFT JOIN kept_line ON seq_rec = operative_incoming AND seq_reserva = booking_id GROUP BY ALL""",
    "contract_interval_join": "SELECT DISTINCT * FROM contract_place",
    "contract_interval_bins": "SELECT DISTINCT * FROM contract_place",
    "day_lines_by_key_filter": f"""SELECT seq_rec, seq_reserva, service_type, {money('imp_venta')} AS imp_venta
        FROM line JOIN booking ON operative_incoming = seq_rec AND booking_id = seq_reserva
        WHERE creation_date BETWEEN DATE '1996-05-01' AND DATE '1996-05-31'""",
    "last_purchase_asof": _purchase(">="),
    "next_purchase_asof": _purchase("<="),
    "input_contract": _contract(),
    "taxes_by_day_sql": f"""SELECT creation_date, booking_currency, count(*) AS bookings, {money('sum(sales_tax)', 2)} AS sales_tax,
        {money('sum(cost_tax)', 2)} AS cost_tax
        FROM booking JOIN (SELECT seq_rec, seq_reserva, sum(sales_tax) AS sales_tax, sum(cost_tax) AS cost_tax FROM kept_line GROUP BY ALL)
        ON operative_incoming = seq_rec AND booking_id = seq_reserva
        WHERE creation_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY ALL""",
    "coalesced_key_join": """SELECT seq_reserva, cod_pais_cliente, gpai_cod_pais_mercado, source_market, source_market_iso FROM sold""",
    "concat_key_join": f"""SELECT h.grec_seq_rec, h.seq_reserva, {_VIEW_MEASURES} FROM head h
        LEFT JOIN sale_view m ON m.grec_seq_rec || '-' || m.rres_seq_reserva = h.grec_seq_rec || '-' || h.seq_reserva
        LEFT JOIN cost_view n ON n.grec_seq_rec || '-' || n.rres_seq_reserva = h.grec_seq_rec || '-' || h.seq_reserva
        LEFT JOIN fee_view o ON o.grec_seq_rec || '-' || o.rres_seq_reserva = h.grec_seq_rec || '-' || h.seq_reserva""",
    "first_row_join": """SELECT h.grec_seq_rec, h.seq_reserva, a.aplicacion FROM head h
        LEFT JOIN application a ON a.grec_seq_rec = h.grec_seq_rec AND a.seq_reserva = h.seq_reserva""",
    "exclusion_keys": "SELECT * FROM excluded",
    "unprofitable_anti": f"""SELECT seq_rec, seq_reserva, ord_extra, count(*) AS n_lines, {money('sum(imp_venta)')} AS venta FROM line l
        WHERE service_type = 'extra' AND {_NOT_EXCLUDED.format('l.seq_rec', 'l.seq_reserva', 'l.ord_extra')} GROUP BY ALL""",
    "cost_anti": f"""SELECT grec_seq_rec AS seq_rec, rres_seq_reserva AS seq_reserva, sdiv_cod_divisa AS cost_currency,
        {money('sum(nights)')} AS nights, CAST(count(nights) AS BIGINT) AS cost_lines FROM kept_cost GROUP BY ALL""",
    "service_union": " UNION ALL ".join(
        f"SELECT seq_rec, seq_reserva, ord_extra, service_type, {money('imp_venta')} AS imp_venta FROM line WHERE service_type = '{name}'"
        for name in ("hotel", "circuit", "other", "transfer", "endowments", "extra")
    ),
    "union_then_sum": f"SELECT seq_rec, seq_reserva, {money('sum(venta)')} AS venta, {money('sum(coste)')} AS coste FROM ("
    + " UNION ALL ".join(
        f"""SELECT seq_rec, seq_reserva, sum(imp_venta) AS venta, sum(imp_coste) AS coste FROM line
            WHERE service_type = '{name}' GROUP BY ALL"""
        for name in ("hotel", "circuit", "other", "transfer", "endowments", "extra")
    )
    + ") GROUP BY ALL",
    "null_safe_total": f"""SELECT operative_incoming, booking_id, {money('coalesce(cost_tax, 0) + coalesce(cost_field, 0)', 2)} AS total,
        {money('coalesce(cost_tax + cost_field, 0)', 2)} AS total_fill_after FROM booking
        LEFT JOIN tax_sum ON seq_rec = operative_incoming AND seq_reserva = booking_id
        LEFT JOIN cost_sum ON grec_seq_rec = operative_incoming AND rres_seq_reserva = booking_id""",
    "tax_sales_by_booking": f"""SELECT seq_rec, seq_reserva, {money('sum(sales_tax)')} AS sales_tax FROM kept_line GROUP BY ALL""",
    "first_booking_ts": """SELECT grec_seq_rec, h.seq_reserva, min(i.fec_creacion) AS first_booking_ts FROM head h
        JOIN info i ON i.seq_rec = h.grec_seq_rec AND i.seq_reserva = h.seq_reserva GROUP BY ALL""",
    "active_services": """SELECT grec_seq_rec, seq_reserva, count(*) AS act_services FROM hotel_sale
        WHERE fec_cancelacion IS NULL GROUP BY ALL""",
    "fx_asof": f"""SELECT b.snapshot_date, b.booking_id, b.creation_date, b.booking_currency, m.rate AS rate_m, r.rate AS rate_r
        FROM (SELECT booking_id, creation_date, booking_currency, {as_of('creation_date')} AS snapshot_date FROM booking) b
        LEFT JOIN fx m ON m.rate_type = 'M' AND m.snapshot_date = b.snapshot_date AND m.currency = b.booking_currency
        LEFT JOIN fx r ON r.rate_type = 'R' AND r.snapshot_date = b.snapshot_date AND r.currency = b.booking_currency""",
    "fx_convert": f"""SELECT grec_seq_rec, rres_seq_reserva, rext_ord_extra, {money('imp_unitario * m.rate / me.rate')} AS eur,
        {money('imp_unitario * m.rate / mu.rate')} AS usd, {money('imp_unitario * r.rate / re.rate')} AS eur_type_r
        FROM (SELECT *, {as_of('CAST(fec_desde AS DATE)')} AS snapshot_date FROM cost) c
        LEFT JOIN fx m ON m.rate_type = 'M' AND m.snapshot_date = c.snapshot_date AND m.currency = sdiv_cod_divisa
        LEFT JOIN fx me ON me.rate_type = 'M' AND me.snapshot_date = c.snapshot_date AND me.currency = 'EUR'
        LEFT JOIN fx mu ON mu.rate_type = 'M' AND mu.snapshot_date = c.snapshot_date AND mu.currency = 'USD'
        LEFT JOIN fx r ON r.rate_type = 'R' AND r.snapshot_date = c.snapshot_date AND r.currency = sdiv_cod_divisa
        LEFT JOIN fx re ON re.rate_type = 'R' AND re.snapshot_date = c.snapshot_date AND re.currency = 'EUR'""",
    "fx_convert_round3": f"SELECT booking_id, {money('o_totalprice * booking_rate / eur_rate', 3)} AS total_eur FROM priced",
    "daily_rate_join": f"""SELECT seq_reserva, gdiv_cod_divisa, {money('rate')} AS day_rate,
        {money('coalesce(pct_comision, 0) * coalesce(rate, 0)')} AS product FROM head
        LEFT JOIN day_rate ON date = CAST(fec_creacion AS DATE) AND currency = gdiv_cod_divisa""",
    "fx_with_spread": f"""SELECT booking_id, spread, {money('eur', 2)} AS eur, {money('eur * (1 + coalesce(pct, 0) / 100)', 2)} AS eur_with_spread
        FROM (SELECT booking_id, (['V', 'C', 'F', 'Z'])[CAST(booking_id % 4 AS INTEGER) + 1] AS spread, o_totalprice * booking_rate / eur_rate AS eur,
            (SELECT CASE (['V', 'C', 'F', 'Z'])[CAST(p.booking_id % 4 AS INTEGER) + 1] WHEN 'V' THEN arg_max(s.pct_venta, s.fec_aplicacion)
                    WHEN 'C' THEN arg_max(s.pct_compra, s.fec_aplicacion) WHEN 'F' THEN arg_max(s.pct_fixing, s.fec_aplicacion) END
                FROM spread s WHERE s.ori = p.booking_currency AND s.des = 'EUR' AND s.fec_aplicacion <= p.creation_date) AS pct
            FROM priced p)""",
    "company_rate_type_asof": """SELECT b.booking_id, b.invoicing_company, b.creation_date, b.purpose,
        coalesce((SELECT CASE b.purpose WHEN 'R' THEN arg_min(s.rex, s.fec_aplicacion) WHEN 'C' THEN arg_min(s.caj, s.fec_aplicacion)
                WHEN 'L' THEN arg_min(s.liq, s.fec_aplicacion) WHEN 'A' THEN arg_min(s.ctb, s.fec_aplicacion) END
            FROM company_setting s WHERE s.semp_cod_emp = b.invoicing_company AND s.fec_aplicacion >= b.creation_date), 'ERROR') AS cod_exchange_type
        FROM (SELECT *, (['R', 'C', 'L', 'A', 'M'])[CAST(booking_id % 5 AS INTEGER) + 1] AS purpose FROM booking) b""",
    "partner_rate_asof": f"""SELECT seq_reserva, gtto_seq_ttoo, gdiv_cod_divisa, {money('rate')} AS rate FROM (
        SELECT h.seq_reserva, h.gtto_seq_ttoo, h.gdiv_cod_divisa,
            CASE WHEN h.gdiv_cod_divisa = 'EUR' THEN 1 WHEN q.ori = h.gdiv_cod_divisa THEN q.nro_tasa ELSE 1 / q.nro_tasa END AS rate
        FROM head h LEFT JOIN partner_quote q ON q.seq_ttoo = h.gtto_seq_ttoo AND q.fec_desde <= CAST(h.fec_creacion AS DATE)
            AND ((q.ori = h.gdiv_cod_divisa AND q.des = 'EUR') OR (q.ori = 'EUR' AND q.des = h.gdiv_cod_divisa))
        QUALIFY row_number() OVER (PARTITION BY h.seq_reserva
            ORDER BY q.fec_desde DESC NULLS LAST, CASE WHEN q.ori = h.gdiv_cod_divisa THEN 1 ELSE 2 END) = 1)""",
    "tax_sales_transfer_pricing": _measure("tax_sales_transfer_pricing"),
    "tax_cost_transfer_pricing": _measure("tax_cost_transfer_pricing"),
    "transfer_pricing": _measure("transfer_pricing"),
    "tax_sales_transfer_pricing_eur": _measure("tax_sales_transfer_pricing_eur"),
    "tax_cost_transfer_pricing_eur": _measure("tax_cost_transfer_pricing_eur"),
    "transfer_pricing_eur": _measure("tax_transfer_pricing_eur"),
    "transfer_price_by_booking": f"SELECT seq_rec, seq_reserva, {money('transfer_tax', 2)} AS impuesto_canco FROM tax_sum",
    "cost_by_booking": f"""SELECT grec_seq_rec AS seq_rec, rres_seq_reserva AS seq_reserva, {money('cost_field', 2)} AS cost_field,
        unconverted AS unconverted_lines FROM cost_sum""",
    "cost_by_booking_eur": f"""SELECT grec_seq_rec AS seq_rec, rres_seq_reserva AS seq_reserva, {money('cost_field_eur', 2)} AS cost_field,
        unconverted_eur AS unconverted_lines FROM cost_sum""",
    "tax_sales_eur_line_level": f"SELECT operative_incoming, booking_id, {money('sales_line_eur', 2)} AS tax_sales_transfer_pricing_eur FROM totals",
    "transfer_eur_line_level": f"SELECT operative_incoming, booking_id, {money('transfer_line_eur', 2)} AS tax_transfer_pricing_eur FROM totals",
    "cost_eur_line_level": f"SELECT operative_incoming, booking_id, {money('cost_line_eur', 2)} AS tax_cost_transfer_pricing_eur FROM totals",
    "sale_tax_lines": f"""SELECT grec_seq_rec_s, rres_seq_reserva,
        CAST(CASE WHEN ind_fec_cam_div = 'E' THEN fec_desde ELSE fec_creacion END AS DATE) AS date_ccy_exchange, regime,
        {money("CASE WHEN regime = 'GN' THEN line_tax ELSE 0 END")} AS tax_aux FROM sale_tax
        UNION ALL SELECT grec_seq_rec, seq_reserva, NULL, NULL, NULL FROM head h
        WHERE NOT EXISTS (SELECT 1 FROM sale_tax s WHERE s.grec_seq_rec_s = h.grec_seq_rec AND s.rres_seq_reserva = h.seq_reserva)""",
    "ttv_by_booking": f"""SELECT h.grec_seq_rec, h.seq_reserva, {money('coalesce(sum(s.amount), 0)')} AS TTV_booking_currency FROM head h
        LEFT JOIN (SELECT *, {nights('fec_desde_s', 'fec_hasta_s')} AS amount FROM charged_sale
            WHERE ind_tipo_registro NOT IN ('O', 'V', 'D', 'W', 'Y', 'IT') AND ind_contra_apunte = 'N') s
        ON s.grec_seq_rec_s = h.grec_seq_rec AND s.rres_seq_reserva = h.seq_reserva GROUP BY ALL""",
    "tax_ttv": _tax_of("GN", "Tax_TTV"),
    "tax_ttv_toms": _tax_of("EN", "Tax_TTV_TOMS"),
    "booking_header": _header(),
    "first_hotel_destination": "SELECT * FROM hotel_first",
    "first_contract_destination": "SELECT * FROM contract_first",
    "first_application": "SELECT * FROM application",
    "distinct_destinations": "SELECT DISTINCT grec_seq_rec, seq_reserva, izge_cod_destino, nom_destino FROM hotel_place",
    "dedup_by_key": """SELECT grec_seq_rec, seq_reserva, izge_cod_destino, nom_destino FROM hotel_place QUALIFY
        row_number() OVER (PARTITION BY grec_seq_rec, seq_reserva ORDER BY izge_cod_destino, nom_destino) = 1""",
    "destination_code": """SELECT b.grec_seq_rec, b.seq_reserva, coalesce(h.izge_cod_destino || '-' || h.nom_destino,
        c.cod_destino || '-' || c.nom_destino2, 'NO_DESTINATION_CODE') AS Destination_code FROM head b
        LEFT JOIN hotel_first h ON h.grec_seq_rec = b.grec_seq_rec AND h.seq_reserva = b.seq_reserva
        LEFT JOIN contract_first c ON c.grec_seq_rec = b.grec_seq_rec AND c.seq_reserva = b.seq_reserva""",
    "booking_extract_wide": _wide(),
    "assemble_extract": f"SELECT {_BOOKING_FIELDS}, {_ALL_MEASURES} FROM measure_eur",
    "daily_extract_full": f"SELECT {_MIDNIGHTS}, {_ALL_MEASURES} FROM measure_eur",
    "daily_extract_one_day": f"SELECT {_MIDNIGHTS}, {_ALL_MEASURES} FROM measure_eur WHERE creation_date = DATE '{RUN_DATE}'",
}

# The same results by another way.
STATEMENTS |= {
    "partner_rate_merge": STATEMENTS["partner_rate_asof"],
    "company_rate_type_merge": STATEMENTS["company_rate_type_asof"],
    "fx_with_spread_merge": STATEMENTS["fx_with_spread"],
}


def _needed(sql: str, seen: dict[str, None]) -> None:
    """Collect the named tables a text mentions, dependencies first."""
    for name in TABLES:
        if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(TABLES[name], seen)
            seen[name] = None


def statements() -> dict[str, str]:
    result = {}
    for name, body in STATEMENTS.items():
        seen: dict[str, None] = {}
        _needed(body, seen)
        expressions = ",\n".join(f"{table} AS ({TABLES[table]})" for table in seen)
        result[name] = f"WITH {expressions}\n{body}" if seen else body
    return result
