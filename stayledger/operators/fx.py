"""Currency conversion by as-of snapshot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.functions.money import round_by_decimals, round_half_up
from stayledger.operators.asof import first_on_or_after, latest_on_or_before
from stayledger.operators.lookup import Lookup, fixed
from stayledger.sources.inline import inline
from stayledger.sources.schemas import SCHEMAS

def rates_from_mapping(spark: SparkSession, mapping: dict) -> DataFrame:
    """Flatten ``{type: {'EXCHANGE_RATES': {date: {currency: rate}}}}`` into a rate table."""
    rows = [
        (rate_type, day, currency, rate)
        for rate_type, content in mapping.items()
        for day, rates in content["EXCHANGE_RATES"].items()
        for currency, rate in rates.items()
    ]
    return inline(spark, rows, SCHEMAS["fx_rate"])


@dataclass(frozen=True)
class FxRates:
    """Rates to a pivot currency, one per (type, snapshot day, currency).

    The snapshot of a day is the latest one not after it, over the days of *all*
    rate types and currencies. A currency missing from that snapshot has no rate:
    there is no fallback to an older one.
    """

    rates: Lookup

    def with_snapshot(self, rows: DataFrame, date: Column, out: str = "snapshot_date") -> DataFrame:
        """Attach the snapshot day of a date; null before the first snapshot.

        Snapshots are spread over the days they are valid for, so the as-of
        lookup is an equality on the day. Days after the last snapshot read as
        the last one. The calendar has one row per day, whatever the data size.
        """
        last = self.rates.frame.agg(F.max("snapshot_date")).scalar()
        # The array holds one element per snapshot day: bounded by the calendar.
        snapshots = self.rates.frame.agg(F.array_sort(F.collect_set("snapshot_date")).alias("_days"))
        starts = snapshots.select("_days", F.posexplode("_days").alias("_position", out))
        following = F.date_sub(F.get("_days", F.col("_position") + 1), 1)
        valid = F.sequence(F.col(out), F.coalesce(following, F.col(out)), F.expr("interval 1 day"))
        calendar = starts.select(F.explode(valid).alias("_day"), out)
        day = F.to_date(date)
        dated = rows.withColumn("_day", F.when(day.isNotNull(), F.least(day, last)))
        return fixed(calendar).join(dated, ["_day"], "left").drop("_day")

    def with_rate(
        self, rows: DataFrame, currency: Column | str, out: str, rate_type: str = "M", snapshot: str = "snapshot_date"
    ) -> DataFrame:
        """Attach the rate of a currency column, or of one currency given by code, in the row's snapshot."""
        side = self.rates.filter(F.col("rate_type") == rate_type)
        if isinstance(currency, str):
            side = side.filter(F.col("currency") == currency).select(
                F.col("snapshot_date").alias(snapshot), F.col("rate").alias(out)
            )
            return side.join(rows, [snapshot], "left")
        side = side.select(
            F.col("snapshot_date").alias(snapshot), F.col("currency").alias("_currency"), F.col("rate").alias(out)
        )
        return side.join(rows.withColumn("_currency", currency), [snapshot, "_currency"], "left").drop("_currency")

    def convert(
        self,
        rows: DataFrame,
        amount: Column,
        source: Column | str,
        target: Column | str,
        date: Column,
        out: str,
        rate_type: str = "M",
    ) -> DataFrame:
        """Add ``out`` = amount converted at the date's snapshot; null when either rate is missing."""
        dated = self.with_snapshot(rows, date, "_snapshot")
        dated = self.with_rate(dated, source, "_from", rate_type, "_snapshot")
        dated = self.with_rate(dated, target, "_to", rate_type, "_snapshot")
        return dated.withColumn(out, exchanged(amount, F.col("_from"), F.col("_to"))).drop("_snapshot", "_from", "_to")


def exchanged(amount: Column, from_rate: Column, to_rate: Column) -> Column:
    """``amount * from_rate / to_rate``, null when a rate is missing."""
    return F.try_divide(amount.cast("double") * from_rate, to_rate)


def exchanged_cents(amount: Column, from_rate: Column, to_rate: Column) -> Column:
    """Conversion rounded to 3 decimals, the precision of a booked amount."""
    return round_half_up(exchanged(amount, from_rate, to_rate), 3)


def round_to_currency(rows: DataFrame, amounts: list[str], currency: str, currencies: Lookup) -> DataFrame:
    """Round columns to the decimals of the row's currency; an unknown currency leaves them unrounded."""
    decimals = currencies.select(F.col("cod_divisa").alias(currency), F.col("decimales").alias("_decimals"))
    joined = decimals.join(rows, [currency], "left")
    return joined.withColumns({a: round_by_decimals(F.col(a), F.col("_decimals")) for a in amounts}).drop("_decimals")


def daily_rates(days: DataFrame, day: str, fx: FxRates, target: str, rate_type: str = "M") -> DataFrame:
    """A (date, currency, rate) table over the distinct days of a column."""
    dated = fx.with_snapshot(days.select(F.to_date(day).alias("date")).distinct(), F.col("date"))
    currencies = fx.rates.filter(F.col("rate_type") == rate_type).select(
        "snapshot_date", "currency", F.col("rate").alias("_from")
    )
    priced = fx.with_rate(currencies.join(dated, ["snapshot_date"]), target, "_to", rate_type)
    return priced.select("date", "currency", exchanged(F.lit(1.0), F.col("_from"), F.col("_to")).alias("rate"))


def company_rate_type(rows: DataFrame, settings: Lookup, company: str, at: str, purpose: str, out: str) -> DataFrame:
    """Rate-type code a company uses for a purpose (R, C, L or A).

    Read from the first setting that applies on or after the date; ``'ERROR'``
    when there is none, or for another purpose.
    """
    matched = first_on_or_after(rows, settings, [(company, "semp_cod_emp")], at, "fec_aplicacion")
    kind = F.col(purpose)
    code = (
        F.when(kind == "R", F.col("tipo_cambio_rex"))
        .when(kind == "C", F.col("tipo_cambio_caj"))
        .when(kind == "L", F.col("tipo_cambio_liq"))
        .when(kind == "A", F.col("tipo_cambio_ctb"))
    )
    found = F.col("fec_aplicacion").isNotNull()
    return matched.withColumn(out, F.when(found & kind.isin("R", "C", "L", "A"), code).otherwise(F.lit("ERROR"))).drop(
        *settings.frame.columns
    )


def partner_rate(
    rows: DataFrame, rates: Lookup, partner: str, source: str, target: str, at: str, out: str
) -> DataFrame:
    """Rate agreed with a partner, from the latest day not after ``at``.

    A quote serves both directions, the reverse one as ``1 / rate``; on one day
    the direct quote wins. A currency against itself is 1.
    """
    up = F.col("cod_divisa_ori") <= F.col("cod_divisa_des")
    quotes = (
        rates.frame.withColumn("_low", F.least("cod_divisa_ori", "cod_divisa_des"))
        .withColumn("_high", F.greatest("cod_divisa_ori", "cod_divisa_des"))
        .groupBy(F.col("seq_ttoo").alias("_partner"), "_low", "_high", F.col("fec_desde").alias("_since"))
        .agg(
            F.max(F.when(up, F.col("nro_tasa"))).alias("_up"),
            F.max(F.when(~up, F.col("nro_tasa"))).alias("_down"),
        )
    )
    keyed = rows.withColumns({"_a": F.least(source, target), "_b": F.greatest(source, target)})
    on = [(partner, "_partner"), ("_a", "_low"), ("_b", "_high")]
    matched = latest_on_or_before(keyed, rates.of(quotes), on, at, "_since")

    def quoted(direct: str, reverse: str) -> Column:
        return F.coalesce(F.col(direct), F.try_divide(F.lit(1.0), F.col(reverse)))

    rate = (
        F.when(F.col(source) == F.col(target), F.lit(1.0))
        .when(F.col(source) < F.col(target), quoted("_up", "_down"))
        .otherwise(quoted("_down", "_up"))
    )
    return matched.withColumn(out, rate).drop("_a", "_b", "_partner", "_low", "_high", "_since", "_up", "_down")


def with_spread(
    rows: DataFrame, spreads: Lookup, rate_type: str, source: str, target: str, at: str, side: str, amount: str, out: str
) -> DataFrame:
    """Add the buy (C), sell (V) or fixing (F) percentage in force at a date to a converted amount."""
    history = spreads.filter(F.col("tipo_cambio") == rate_type).select(
        F.col("cod_divisa_orien").alias("_from_ccy"),
        F.col("cod_divisa_destino").alias("_to_ccy"),
        F.col("fec_aplicacion").alias("_applies"),
        "pct_venta",
        "pct_compra",
        "pct_fixing",
    )
    matched = latest_on_or_before(rows, history, [(source, "_from_ccy"), (target, "_to_ccy")], at, "_applies")
    kind = F.col(side)
    percent = (
        F.when(kind == "V", F.col("pct_venta"))
        .when(kind == "C", F.col("pct_compra"))
        .when(kind == "F", F.col("pct_fixing"))
    )
    raised = F.col(amount) * (F.lit(1.0) + F.coalesce(percent, F.lit(0.0)) / F.lit(100.0))
    return matched.withColumn(out, raised).drop(
        "_from_ccy", "_to_ccy", "_applies", "pct_venta", "pct_compra", "pct_fixing"
    )
