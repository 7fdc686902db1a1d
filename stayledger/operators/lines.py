"""Service lines: six tables read as one, with their two tax percentages."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.functions.money import cost_tax, sales_tax, tax_share
from stayledger.operators.exclusions import EXTRA, without_excluded
from stayledger.operators.lookup import Lookup

# The service tables.
SERVICES = ("hotel", "circuit", "other", "transfer", "endowments", "extra")

# (column of the line, column of the tax table)
TAX_KEY = (
    ("ind_tipo_imp_vta_fac", "ind_tipo_imp"),
    ("cod_impuesto_vta_fac", "cod_impuesto"),
    ("cod_clasif_vta_fac", "cod_clasif"),
    ("cod_esquema_vta_fac", "cod_esquema"),
    ("cod_empresa_vta_fac", "cod_emp_atlas"),
)

LINE = (
    "seq_rec",
    "seq_reserva",
    "ind_tipo_regimen_fac",
    "ind_tipo_regimen_con",
    "imp_venta",
    "imp_coste",
    "imp_margen_canal",
    "imp_margen_canco",
    *(line for line, _ in TAX_KEY),
)


def service_lines(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All service tables as one, tagged with ``service_type``; only extras have an ``ord_extra``.

    Joining taxes and summing happen once over the union, not once per table.
    """
    tagged = [
        tables[name]
        .select(
            *LINE, F.col("ord_extra") if name == "extra" else F.lit(None).cast("bigint").alias("ord_extra")
        )
        .withColumn("service_type", F.lit(name))
        for name in SERVICES
    ]
    return reduce(DataFrame.unionByName, tagged)


def with_tax(lines: DataFrame, tax: Lookup, tax_type_on_sales_join: bool = True) -> DataFrame:
    """Attach the sales-side (``vta``) and purchase-side (``cpa``) tax: percentage and share of a gross amount.

    Lines without a tax row are dropped. Leaving the tax type out of the
    sales-side key repeats a line for every tax type that shares its code. The
    share is worked out once per tax row, not once per line.
    """

    def side(key: tuple[tuple[str, str], ...], name: str) -> Lookup:
        percent = F.col("pct_impuesto")
        return tax.select(
            *(F.col(table).alias(line) for line, table in key),
            percent.alias(f"pct_{name}"),
            tax_share(percent).alias(f"share_{name}"),
        )

    sales_key = TAX_KEY if tax_type_on_sales_join else TAX_KEY[1:]
    lines = side(sales_key, "vta").join(lines, [line for line, _ in sales_key])
    return side(TAX_KEY, "cpa").join(lines, [line for line, _ in TAX_KEY])


def with_tax_amounts(taxed: DataFrame) -> DataFrame:
    """Add ``sales_tax`` and ``cost_tax`` of each line."""
    columns = {name: F.col(name) for name in taxed.columns}
    return taxed.withColumns({"sales_tax": sales_tax(columns), "cost_tax": cost_tax(columns)})


def tax_by_booking(lines: DataFrame, tax: Lookup, exclusions: DataFrame, tax_type_on_sales_join: bool = True) -> DataFrame:
    """Sales and cost tax per booking, extras of unprofitable campaigns left out.

    Lines are summed by (booking, extra) before anything is shuffled, so the
    exclusion and the total see at most one row per extra and a booking with
    very many lines is already small.
    """
    amounts = with_tax_amounts(with_tax(lines, tax, tax_type_on_sales_join))
    sums = [F.sum(name).alias(name) for name in ("sales_tax", "cost_tax")]
    by_extra = amounts.groupBy(*EXTRA).agg(*sums)
    return without_excluded(by_extra, exclusions).groupBy("seq_rec", "seq_reserva").agg(*sums)
