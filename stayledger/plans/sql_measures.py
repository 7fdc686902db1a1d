"""Measures as SQL text over registered views, one statement per service table.

For users who keep their calculation in SQL. The statements are fixed texts; tables and values are parameters, so no
text is put together from names. A statement sums its table by booking and extra, and the sums of all tables are added, so
each table is read once and only sums move. Exclusions and days are looked up once, for the sums of all tables: each table by
itself would hold its own sorted lines, in the one task that adds the tables up for a part of the bookings.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.operators.exclusions import EXTRA
from stayledger.operators.lines import SERVICES
from stayledger.operators.measures import Books
from stayledger.sources.catalog import register_views

# Sales and cost tax of one service table by booking and extra.
TAXES = """
SELECT l.seq_rec, l.seq_reserva, l.ord_extra,
       sum(coalesce(CASE WHEN l.ind_tipo_regimen_fac = 'E' THEN l.imp_margen_canal * vta.share
                         ELSE l.imp_venta * vta.share - (l.imp_venta - l.imp_margen_canal) * cpa.share END, 0D)) AS sales_tax,
       sum(coalesce(CASE WHEN l.ind_tipo_regimen_con = 'E' THEN l.imp_margen_canco * vta.share
                         ELSE (l.imp_coste + l.imp_margen_canco) * vta.share - l.imp_coste * cpa.share END, 0D)) AS cost_tax
FROM IDENTIFIER(:lines) l
JOIN IDENTIFIER(:shares) vta
  ON vta.ind_tipo_imp = l.ind_tipo_imp_vta_fac AND vta.cod_impuesto = l.cod_impuesto_vta_fac AND vta.cod_clasif = l.cod_clasif_vta_fac
 AND vta.cod_esquema = l.cod_esquema_vta_fac AND vta.cod_emp_atlas = l.cod_empresa_vta_fac
JOIN IDENTIFIER(:shares) cpa
  ON cpa.ind_tipo_imp = l.ind_tipo_imp_vta_fac AND cpa.cod_impuesto = l.cod_impuesto_vta_fac AND cpa.cod_clasif = l.cod_clasif_vta_fac
 AND cpa.cod_esquema = l.cod_esquema_vta_fac AND cpa.cod_emp_atlas = l.cod_empresa_vta_fac
GROUP BY l.seq_rec, l.seq_reserva, l.ord_extra
"""

# The same by booking, extras of unprofitable campaigns left out, bookings of a range of days.
INCLUDED = """
SELECT s.seq_rec, s.seq_reserva, sum(s.sales_tax) AS sales_tax, sum(s.cost_tax) AS cost_tax
FROM IDENTIFIER(:sums) s
LEFT ANTI JOIN IDENTIFIER(:excluded) x
  ON x.seq_rec = s.seq_rec AND x.seq_reserva = s.seq_reserva AND x.ord_extra = s.ord_extra
LEFT SEMI JOIN IDENTIFIER(:bookings) b
  ON b.operative_incoming = s.seq_rec AND b.booking_id = s.seq_reserva AND b.creation_date BETWEEN :first_day AND :last_day
GROUP BY s.seq_rec, s.seq_reserva
"""

# The share of a gross amount that is tax, per tax row; -100 percent leaves no net amount and gives null.
SHARES = """
SELECT *, 1D - try_divide(1D, 1D + pct_impuesto / 100D) AS share FROM IDENTIFIER(:tax)
"""

# Lines of one currency by booking currency and day: how many bookings and how much tax there was.
BY_DAY = """
SELECT b.creation_date, b.booking_currency, count(*) AS bookings, sum(t.sales_tax) AS sales_tax, sum(t.cost_tax) AS cost_tax
FROM IDENTIFIER(:taxes) t
JOIN IDENTIFIER(:bookings) b ON b.operative_incoming = t.seq_rec AND b.booking_id = t.seq_reserva
GROUP BY b.creation_date, b.booking_currency
"""


class SqlMeasures:
    """The measures of some books as SQL; ``prefix`` tells the views of one instance from those of others."""

    def __init__(self, spark: SparkSession, books: Books, bookings: DataFrame, prefix: str = "stayledger_"):
        self.spark, self.prefix = spark, prefix
        tables = {f"service_{name}": books.lines.where(F.col("service_type") == name) for name in SERVICES}
        tables |= {"tax": books.tax.frame, "excluded": books.exclusions(), "bookings": bookings}
        register_views(tables, prefix)
        self._view("shares", SHARES, tax="tax")

    def _name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def statement(self, text: str, values: Mapping[str, object] | None = None, **tables: str) -> DataFrame:
        """The result of a statement; ``tables`` are names of this instance's views, ``values`` the other parameters."""
        return self.spark.sql(text, args={name: self._name(table) for name, table in tables.items()} | dict(values or {}))

    def _view(self, name: str, text: str, values: Mapping[str, object] | None = None, **tables: str) -> DataFrame:
        frame = self.statement(text, values, **tables)
        register_views({name: frame}, self.prefix)
        return frame

    def taxes(self, first_day: date, last_day: date) -> DataFrame:
        """Sales and cost tax by booking over all service tables, for the bookings created in a range of days."""
        parts = [self.statement(TAXES, lines=f"service_{name}", shares="shares") for name in SERVICES]
        sums = reduce(DataFrame.unionByName, parts).groupBy(*EXTRA)
        sums = sums.agg(F.sum("sales_tax").alias("sales_tax"), F.sum("cost_tax").alias("cost_tax"))
        register_views({"sums": sums}, self.prefix)
        days = {"first_day": first_day, "last_day": last_day}
        return self.statement(INCLUDED, days, sums="sums", excluded="excluded", bookings="bookings")

    def taxes_by_day(self, first_day: date, last_day: date) -> DataFrame:
        """The same by day of creation and booking currency."""
        register_views({"taxes": self.taxes(first_day, last_day)}, self.prefix)
        return self.statement(BY_DAY, taxes="taxes", bookings="bookings")
