"""The sample tables in the roles of the engine's sources.

Orders play bookings and line items play services, costs and sales. Both derive
the office number from the order number, so no role needs a join of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators.fx import FxRates, daily_rates
from stayledger.operators.lookup import Lookup, fixed, measured_together
from stayledger.operators.measures import Books
from stayledger.plans.wide import HeaderTables
from stayledger.sources.inline import inline
from stayledger.sources.schemas import SCHEMAS
from workload import values

OFFICES = 25

_CODES = ", ".join(f"'{code}'" for code in values.CURRENCIES)


def _currency(number: str) -> str:
    return f"element_at(array({_CODES}), cast({number} % 5 as int) + 1)"


_LINE = (
    f"l_orderkey % {OFFICES} as seq_rec",
    "l_orderkey as seq_reserva",
    "case when l_linenumber = 7 then null when l_linenumber % 2 = 0 then 'E' else 'G' end as ind_tipo_regimen_fac",
    "case when l_suppkey % 2 = 0 then 'E' else 'G' end as ind_tipo_regimen_con",
    "l_extendedprice as imp_venta",
    "l_extendedprice * (1 - l_discount) as imp_coste",
    "case when l_quantity = 50 then null else l_extendedprice * l_discount end as imp_margen_canal",
    "l_extendedprice * l_discount * 0.5D as imp_margen_canco",
    "'I' as ind_tipo_imp_vta_fac",
    "cast(cast(round(l_tax * 100) as int) as string) as cod_impuesto_vta_fac",
    "'C' as cod_clasif_vta_fac",
    "'S' as cod_esquema_vta_fac",
    "'E' as cod_empresa_vta_fac",
)

# (service, return flag, line status)
_SERVICE_FLAGS = (
    ("hotel", "A", "F"),
    ("circuit", "A", "O"),
    ("other", "N", "F"),
    ("transfer", "N", "O"),
    ("endowments", "R", "F"),
    ("extra", "R", "O"),
)

_DATED = (
    "cast(l_quantity as int) as nro_unidades",
    "l_linenumber as nro_pax",
    "case l_returnflag when 'A' then 'N' when 'N' then 'S' else 'P' end as ind_tipo_unid",
    "case l_linestatus when 'F' then 'P' else 'S' end as ind_p_s",
    "case when l_quantity = 48 then null else floor(l_extendedprice) / 100 end as imp_unitario",
)

_END = "case when l_quantity = 49 then null else l_shipdate + make_dt_interval(l_linenumber) end"


# Declared, so that no file is opened before a query runs.
SAMPLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """
        o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string
    """,
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz
    """,
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Columns of the three per-booking measure views.
SALE_MEASURES = ("ttv", "tax_ttv", "tax_ttv_toms", "cli_comm", "tax_client_com", "cli_rappel", "tax_cli_rappel", "gsa_comm", "tax_gsa_comm")
COST_MEASURES = ("booking_cost", "tax_cost", "tax_cost_toms")
FEE_MEASURES = (
    "agency_commision_hotel_payment_eur",
    "tax_agency_commision_hotel_pay_eur",
    "fix_override_hotel_payment_eur",
    "tax_fix_override_hotel_pay_eur",
    "var_override_hotel_payment_eur",
    "tax_var_override_hotel_pay_eur",
    "hotel_commision_hotel_payment_eur",
    "tax_hotel_commision_hotel_pay_eur",
    "marketing_contribution_eur",
    "tax_marketing_contribution_eur",
    "bank_expenses_eur",
    "tax_bank_expenses_eur",
    "platform_fee_eur",
    "tax_platform_fee_eur",
    "credit_card_fee_eur",
    "tax_credit_card_fee_eur",
    "withholding_eur",
    "tax_withholding_eur",
    "local_levy_eur",
    "tax_local_levy_eur",
    "partner_third_commision_eur",
    "tax_partner_third_commision_eur",
)

# Rows that a lookup's explodes make of one row of its table, at most. Destinations have two names a nation, of which
# every join reads the English one.
FANOUTS = {"contracts": 10, "partner_rates": 6}

# One row a day and currency, whatever the data size. Spark's estimate is the product of all that they are joined from.
BY_CALENDAR = ("daily_rates",)


class Roles:
    """Role frames over one folder of sample tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._lookups: dict[str, Lookup] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(SAMPLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def lookups(self, *names: str) -> list[Lookup]:
        """Lookups by role name; the sizes not known yet are checked in one job."""
        new = [name for name in names if name not in self._lookups]
        frames = {name: getattr(self, f"_{name}")() for name in new}
        bounded = {name: fixed(frames.pop(name)) for name in new if name in BY_CALENDAR}
        self._lookups |= bounded | measured_together(frames, fanouts=FANOUTS)
        return [self._lookups[name] for name in names]

    def lookup(self, name: str) -> Lookup:
        return self.lookups(name)[0]

    def _values(self, rows: Sequence[tuple], ddl: str) -> Lookup:
        return fixed(inline(self.spark, rows, ddl))

    # -- bookings ---------------------------------------------------------

    @cached_property
    def booking_view(self) -> DataFrame:
        return self.table("orders").selectExpr(
            f"o_orderkey % {OFFICES} as operative_incoming",
            "o_orderkey as booking_id",
            "'E' || cast(o_custkey % 7 as string) as invoicing_company",
            "cast(o_orderdate as date) as creation_date",
            f"{_currency('o_custkey')} as booking_currency",
            "case when o_orderpriority in ('1-URGENT', '2-HIGH') then cast(date_add(o_orderdate, 3) as string) else '' end as modification_date",
            "case when o_orderstatus = 'F' then cast(date_add(o_orderdate, 10) as string) else '' end as cancellation_date",
            "cast(o_orderdate as date) as status_date",
            "date_add(o_orderdate, 30) as booking_service_from",
            "date_add(o_orderdate, 37) as booking_service_to",
            "0.0D as tax_sales_transfer_pricing",
            "0.0D as tax_sales_transfer_pricing_eur",
            "0.0D as transfer_pricing",
            "0.0D as tax_transfer_pricing_eur",
            "0.0D as tax_cost_transfer_pricing",
            "0.0D as tax_cost_transfer_pricing_eur",
        )

    @cached_property
    def booking_amounts(self) -> DataFrame:
        """An amount in booking currency on each booking."""
        return self.table("orders").selectExpr(
            "o_orderkey as booking_id",
            "cast(o_orderdate as date) as creation_date",
            f"{_currency('o_custkey')} as booking_currency",
            "o_totalprice as amount",
        )

    @cached_property
    def header(self) -> DataFrame:
        return self.table("orders").selectExpr(
            f"o_orderkey % {OFFICES} as grec_seq_rec",
            "o_orderkey as seq_reserva",
            f"{_currency('o_custkey')} as gdiv_cod_divisa",
            "o_orderdate as fec_creacion",
            "case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_orderdate + interval 3 days end as fec_modifica",
            "case when o_orderstatus = 'F' then o_orderdate + interval 10 days end as fec_cancelacion",
            "o_orderdate + interval 30 days as fec_desde",
            "o_orderdate + interval 37 days as fec_hasta",
            "o_custkey as gtto_seq_ttoo",
            f"case when o_orderkey % 3 = 0 then null else cast(o_orderkey % {OFFICES} as string) end as cod_pais_cliente",
            "cast(o_custkey % 4 + 1 as int) as nro_ad",
            "cast(o_custkey % 3 as int) as nro_ni",
            "'I' || cast(o_orderkey % 6 as string) as fint_cod_interface",
            "o_custkey % 30 as seq_rec_invoicing",
            "o_orderpriority || ';' || cast(o_orderkey as string) || ';' as nom_general",
            "substr(o_orderpriority, 1, 1) as ind_tipo_credito",
            "'D' || cast(o_custkey % 9 as string) as gdep_cod_depart",
            "o_orderstatus as rtre_cod_tipo_res",
            "case when o_orderkey % 2 = 0 then 'S' else 'N' end as ind_facturable_res",
            "case when o_orderkey % 5 = 0 then 'S' else 'N' end as ind_facturable_adm",
            "case when o_orderkey % 4 = 0 then null else cast(o_orderkey % 4 as double) / 2 end as pct_comision",
            "case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 5 as double) / 4 end as pct_rappel",
            "case when o_orderstatus = 'O' then 'N' else 'S' end as ind_confirma",
            f"case when o_orderkey % 7 = 0 then {_currency('o_orderkey')} end as cod_divisa_p",
            "case when o_orderkey % 7 = 0 then o_custkey end as seq_ttoo_p",
            "case when o_orderkey % 7 = 0 then o_custkey % 11 end as cod_suc_p",
            "case when o_orderkey % 14 = 0 then o_custkey % 13 end as seq_agencia_p",
            "case when o_orderkey % 14 = 0 then o_custkey % 17 end as seq_sucursal_p",
            f"case when o_orderkey % 10 = 0 then o_orderkey % {OFFICES} end as seq_rec_expediente",
            "case when o_orderkey % 10 = 0 then o_orderkey end as seq_res_expediente",
            "case when o_orderkey % 4 = 1 then 'H' end as ind_tippag",
            "case when o_orderkey % 6 = 0 then 'E' when o_orderkey % 6 = 1 then null else 'C' end as ind_fec_cam_div",
        )

    # -- lines ------------------------------------------------------------

    def service_tables(self) -> dict[str, DataFrame]:
        """The six service tables, one filtered scan each."""
        lines = self.table("lineitem")
        return {
            name: lines.filter(f"l_returnflag = '{flag}' and l_linestatus = '{status}'").selectExpr(
                *_LINE, *(["cast(l_linenumber as bigint) as ord_extra"] if name == "extra" else [])
            )
            for name, flag, status in _SERVICE_FLAGS
        }

    @cached_property
    def lines(self) -> DataFrame:
        """The tagged union of the service tables in one scan, for they share one file here."""
        tag = " ".join(
            f"when l_returnflag = '{flag}' and l_linestatus = '{status}' then '{name}'"
            for name, flag, status in _SERVICE_FLAGS
        )
        return self.table("lineitem").selectExpr(
            *_LINE,
            "case when l_returnflag = 'R' and l_linestatus = 'O' then cast(l_linenumber as bigint) end as ord_extra",
            f"case {tag} end as service_type",
        )

    @cached_property
    def costs(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            f"l_orderkey % {OFFICES} as grec_seq_rec",
            "l_orderkey as rres_seq_reserva",
            "cast(l_linenumber as bigint) as rext_ord_extra",
            f"{_currency('l_suppkey')} as sdiv_cod_divisa",
            "l_shipdate as fec_desde",
            f"{_END} as fec_hasta",
            *_DATED,
            "case when l_tax = 0 then 'BT' else 'DR' end as ind_tipo_registro",
            "case when l_discount = 0 then 'N' else 'S' end as ind_facturable",
        )

    @cached_property
    def sales(self) -> DataFrame:
        types = "array('O', 'V', 'D', 'W', 'Y', 'IT', 'CH', 'BT')"
        return self.table("lineitem").selectExpr(
            f"l_orderkey % {OFFICES} as grec_seq_rec_s",
            "l_orderkey as rres_seq_reserva",
            "l_shipdate as fec_desde_s",
            f"{_END} as fec_hasta_s",
            *_DATED,
            f"coalesce(try_element_at({types}, cast(round(l_discount * 100) as int) + 1), 'H') as ind_tipo_registro",
            "case when l_partkey % 4 = 0 then 'N' else 'S' end as ind_facturable",
            "case when l_partkey % 9 = 0 then 'S' else 'N' end as ind_contra_apunte",
            "case when l_suppkey % 2 = 0 then l_extendedprice * l_tax end as imp_impuesto",
            "case when l_linenumber = 7 then null when l_linenumber % 2 = 0 then 'E' else 'G' end as ind_tipo_regimen",
            "case l_suppkey % 3 when 1 then 'N' when 2 then 'S' end as ind_trfprc",
            "'I' as rvp_ind_tipo_imp",
            "case when l_quantity = 47 then '99' else cast(cast(round(l_tax * 100) as int) as string) end as rvp_cod_impuesto",
            "'S' as rvp_cod_esquema",
            "'C' as rvp_cod_clasif",
            "'E' as rvp_cod_empresa",
        )

    @cached_property
    def extra_bonds(self) -> DataFrame:
        return self.table("lineitem").filter("l_returnflag = 'R' and l_linestatus = 'O'").selectExpr(
            f"l_orderkey % {OFFICES} as grec_seq_rec",
            "l_orderkey as rres_seq_reserva",
            "cast(l_linenumber as bigint) as ord_extra",
            "l_partkey as num_bono",
            "'I' || cast(l_suppkey % 2 as string) as cod_interface",
        )

    def _discount_bonds(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as num_bono",
            "'I' || cast(p_partkey % 2 as string) as cod_interface",
            "p_type as cod_campana",
        )

    # -- written-out dimensions -------------------------------------------

    @cached_property
    def campaigns(self) -> Lookup:
        return self._values(values.CAMPAIGNS, SCHEMAS["campaign"])

    @cached_property
    def tax(self) -> Lookup:
        return self._values(values.TAX, SCHEMAS["tax"])

    @cached_property
    def currencies(self) -> Lookup:
        return self._values(values.DECIMALS, SCHEMAS["currency"])

    @cached_property
    def currencies_without_kwd(self) -> Lookup:
        return self._values(values.DECIMALS_WITHOUT_KWD, SCHEMAS["currency"])

    @cached_property
    def fx(self) -> FxRates:
        rows = [(kind, date.fromisoformat(day), code, rate) for kind, day, code, rate in values.FX]
        return FxRates(self._values(rows, SCHEMAS["fx_rate"]))

    @cached_property
    def company_rate_types(self) -> Lookup:
        rows = [(company, date.fromisoformat(day), *codes) for company, day, *codes in values.COMPANY_RATE_TYPES]
        return self._values(
            rows,
            "semp_cod_emp string, fec_aplicacion date, tipo_cambio_rex string, tipo_cambio_caj string, tipo_cambio_liq string, tipo_cambio_ctb string",
        )

    @cached_property
    def spreads(self) -> Lookup:
        rows = [(kind, source, target, date.fromisoformat(day), *percents) for kind, source, target, day, *percents in values.SPREADS]
        return self._values(
            rows,
            "tipo_cambio string, cod_divisa_orien string, cod_divisa_destino string, fec_aplicacion date, pct_venta double, pct_compra double, pct_fixing double",
        )

    # -- header tables ----------------------------------------------------

    def _operators(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as seq_ttoo", "c_name as nom_corto_ttoo", "cast(c_nationkey as string) as gpai_cod_pais_mercado"
        )

    def _countries(self) -> DataFrame:
        return self.table("nation").selectExpr("cast(n_nationkey as string) as cod_pais", "'X' || cast(n_nationkey as string) as cod_iso")

    def _receptives(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "cast(n_nationkey as bigint) as seq_rec",
            "'C' || cast(n_regionkey as string) as semp_cod_emp",
            "'O' || cast(n_nationkey as string) as sofi_cod_ofi",
            "n_name as des_receptivo",
        )

    def _interfaces(self) -> DataFrame:
        return self.table("region").selectExpr(
            "'I' || cast(r_regionkey as string) as cod_interface",
            "case when r_regionkey in (1, 3) then null else r_name end as partner_ttoo",
        )

    @cached_property
    def information(self) -> DataFrame:
        return self.table("events").selectExpr(
            f"user_id % {OFFICES} as seq_rec",
            "user_id as seq_reserva",
            "ts as fec_creacion",
            "case when event_type in ('view', 'click', 'purchase') then 'A' else 'B' end as tipo_op",
            "event_type as aplicacion",
        )

    @cached_property
    def hotel_sales(self) -> DataFrame:
        return self.table("lineitem").filter("l_returnflag = 'A' and l_linestatus = 'F'").selectExpr(
            f"l_orderkey % {OFFICES} as grec_seq_rec",
            "l_orderkey as rres_seq_reserva",
            "l_suppkey as ghor_seq_hotel",
            "case when l_discount < 0.05 then null else l_shipdate end as fec_cancelacion",
        )

    def _hotels(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey as seq_hotel", "'D' || cast(s_nationkey as string) as izge_cod_destino")

    def _destinations(self) -> DataFrame:
        languages = self.table("nation").selectExpr(
            "'D' || cast(n_nationkey as string) as ides_cod_destino",
            "n_name",
            "explode(array('ENG', 'SPA')) as sidi_cod_idioma",
        )
        return languages.selectExpr(
            "ides_cod_destino",
            "case sidi_cod_idioma when 'ENG' then n_name else n_name || '_ES' end as nom_destino",
            "sidi_cod_idioma",
        )

    @cached_property
    def others(self) -> DataFrame:
        return self.table("lineitem").filter("l_returnflag = 'N' and l_linestatus = 'F'").selectExpr(
            f"l_orderkey % {OFFICES} as seq_rec",
            "l_orderkey as seq_reserva",
            "'CT' || cast(l_partkey as string) as nom_contrato",
            "'T' || cast(l_partkey % 3 as string) as ind_tipo_otro",
            "cast(l_shipdate as date) as fec_desde",
        )

    def _contracts(self) -> DataFrame:
        """Two overlapping terms per part, in the five offices that share its number modulo 5."""
        terms = (
            self.table("part")
            .selectExpr("p_partkey", "explode(sequence(p_partkey % 5, 24L, 5L)) as seq_rec")
            .selectExpr("p_partkey", "seq_rec", "explode(array(0, 1)) as term")
        )
        return terms.selectExpr(
            "seq_rec",
            "'CT' || cast(p_partkey as string) as nom_contrato",
            "'T' || cast(p_partkey % 3 as string) as ind_tipo_otro",
            "case term when 0 then date'1995-01-01' else date'1997-07-01' end as fec_desde",
            "case term when 0 then date'1997-12-31' else date'2000-06-30' end as fec_hasta",
            "'D' || cast((p_partkey + term) % 30 as string) as cod_destino",
        )

    @cached_property
    def resales(self) -> DataFrame:
        return self.table("orders").filter("o_orderkey % 2 = 0").selectExpr(
            f"o_orderkey % {OFFICES} as seq_rec",
            "o_orderkey as seq_reserva",
            "case when o_orderkey % 10 = 4 then 'ZZ' when o_orderstatus = 'P' then 'RR' when o_orderstatus = 'O' then 'CN' else 'RL' end as ind_status",
        )

    def _partner_rates(self) -> DataFrame:
        """Partners quote against EUR: some out of it, some into it, some both on one day."""
        quotes = self.table("customer").selectExpr(
            "c_custkey",
            f"{_currency('c_custkey')} as currency",
            "explode(array(date'1995-06-01', date'1998-06-01', date'2000-01-01')) as fec_desde",
        )
        both = quotes.selectExpr("c_custkey", "currency", "fec_desde", "explode(array('out', 'in')) as way")
        kept = both.filter(
            "currency <> 'EUR' and (way = 'out' and c_custkey % 2 = 0 or way = 'in' and c_custkey % 4 <> 0)"
        )
        return kept.selectExpr(
            "c_custkey as seq_ttoo",
            "fec_desde",
            "case way when 'out' then currency else 'EUR' end as cod_divisa_ori",
            "case way when 'out' then 'EUR' else currency end as cod_divisa_des",
            "case way when 'out' then 0.5D + cast(c_custkey % 7 as double) / 8 else 2.0D + cast(year(fec_desde) % 4 as double) / 4 end as nro_tasa",
        )

    def _daily_rates(self) -> DataFrame:
        return daily_rates(self.table("orders"), "o_orderdate", self.fx, "EUR")

    @cached_property
    def measure_views(self) -> list[DataFrame]:
        """Three per-booking views that together hold every measure column."""
        lines = self.table("lineitem")
        key = [f"l_orderkey % {OFFICES} as grec_seq_rec", "l_orderkey as rres_seq_reserva"]

        # Lines of a booking lie apart, so a task's sums are nearly as many as its lines, and each has a column per
        # measure. The lines are dealt out by booking instead, once for all views.
        keyed = lines.selectExpr(*key, "l_extendedprice").repartition("grec_seq_rec", "rres_seq_reserva")

        def view(columns: list[str]) -> DataFrame:
            sums = [f"sum(l_extendedprice * {n + 1}) / 1000 as {name}" for n, name in enumerate(columns)]
            return keyed.groupBy("grec_seq_rec", "rres_seq_reserva").agg(*(F.expr(s) for s in sums))

        return [
            view(list(SALE_MEASURES)),
            view(list(COST_MEASURES)),
            view(list(FEE_MEASURES)),
        ]

    # -- grouped inputs ---------------------------------------------------

    def books(self, **changes) -> Books:
        inputs = {
            "lines": self.lines,
            "costs": self.costs,
            "extra_bonds": self.extra_bonds,
            "discount_bonds": self.lookup("discount_bonds"),
            "campaigns": self.campaigns,
            "tax": self.tax,
            "currencies": self.currencies,
            "fx": self.fx,
        }
        return Books(**{**inputs, **changes})

    def header_tables(self) -> HeaderTables:
        names = ("operators", "countries", "receptives", "interfaces", "hotels", "contracts", "destinations", "daily_rates")
        return HeaderTables(
            header=self.header,
            information=self.information,
            hotel_sales=self.hotel_sales,
            others=self.others,
            resales=self.resales,
            measures=self.measure_views,
            **dict(zip(names, self.lookups(*names), strict=True)),
        )
