"""What the inputs break of what the joins rely on, as a ledger of rows and amounts.

Lookups must hold one row per key, or a join repeats lines; lines need a tax row and a booking, or an inner join drops
them. The calculation does neither silently: every rule has a row here, with how many rows break it and what they are worth.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.operators.keys import BOOKING
from stayledger.operators.lines import TAX_KEY
from stayledger.operators.lookup import Lookup

# Rules.
REPEATED = "repeated key"
UNKEYED = "key missing"
READ = "lines read"
SUMMED = "lines summed"
NO_SALES_TAX = "no sales tax row"
NO_PURCHASE_TAX = "no purchase tax row"
NO_BOOKING = "no booking"


def _ledger(frame: DataFrame, table: str, figures: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One aggregate over a frame as rows (table, rule, rows, amount)."""
    sums = frame.agg(*(f.alias(f"_{i}{part}") for i, pair in enumerate(figures.values()) for part, f in zip("ra", pair, strict=True)))
    rows = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"),
                F.coalesce(F.col(f"_{i}r"), F.lit(0)).cast("bigint").alias("rows"),
                F.coalesce(F.col(f"_{i}a"), F.lit(0)).cast("double").alias("amount"),
            )
            for i, rule in enumerate(figures)
        )
    )
    return sums.select(F.lit(table).alias("table_name"), F.explode(rows).alias("x")).select("table_name", "x.*")


def key_rules(frame: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key, and rows whose key is null somewhere and so matches nothing; they are worth nothing by themselves.

    Rows are counted by key before they move, so a key of very many rows is one row per task.
    """
    missing = reduce(lambda a, b: a | b, (F.col(name).isNull() for name in key))
    counted = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    surplus = F.sum(F.when(~missing, F.col("_n") - 1))
    unkeyed = F.sum(F.when(missing, F.col("_n")))
    return _ledger(counted, table, {REPEATED: (surplus, F.lit(0)), UNKEYED: (unkeyed, F.lit(0))})


@dataclass(frozen=True)
class Lines:
    """A table of lines: where its booking and its amount stand, and the tax rows that each of its rows needs.

    ``needs`` maps a rule to the (column of the line, column of the tax table) pairs of its key.
    """

    frame: DataFrame
    office: str
    booking: str
    amount: str
    needs: Mapping[str, Sequence[tuple[str, str]]] = field(default_factory=dict)


def service_needs(tax_type_on_sales_join: bool = True) -> dict[str, Sequence[tuple[str, str]]]:
    return {NO_SALES_TAX: TAX_KEY if tax_type_on_sales_join else TAX_KEY[1:], NO_PURCHASE_TAX: TAX_KEY}


def line_rules(lines: Lines, table: str, tax: Lookup, bookings: Lookup) -> DataFrame:
    """Lines read, lines that reach the sums, and why the others do not.

    The reasons are tested in order, tax rows first as the calculation joins them first, and a line counts under the
    first that holds, so what is read is what is summed and dropped, in rows and in amounts. A line counts once even if
    a repeated key repeats it; ``key_rules`` tells of those.

    Lines are summed by booking and by the tax rows they have before they meet the bookings.
    """
    columns = dict.fromkeys(line for key in lines.needs.values() for line, _ in key)
    rows = lines.frame.select(
        F.col(lines.office).alias("_office"), F.col(lines.booking).alias("_booking"), *columns, F.col(lines.amount).cast("decimal(28,6)").alias("_amount")
    )
    flags = []
    for i, key in enumerate(lines.needs.values()):
        flags.append(f"_has{i}")
        known = tax.frame.select(*(F.col(column).alias(line) for line, column in key)).distinct().withColumn(flags[i], F.lit(True))
        rows = tax.of(known).join(rows, [line for line, _ in key], "left")
    summed = rows.groupBy("_office", "_booking", *flags).agg(F.count(F.lit(1)).alias("_rows"), F.sum("_amount").alias("_amount"))
    pairs = bookings.frame.select(F.col(BOOKING[0]).alias("_office"), F.col(BOOKING[1]).alias("_booking")).distinct()
    judged = bookings.of(pairs.withColumn("_booked", F.lit(True))).join(summed, ["_office", "_booking"], "left")
    reason = F.when(F.col("_booked").isNull(), NO_BOOKING).otherwise(SUMMED)
    for rule, flag in reversed(list(zip(lines.needs, flags, strict=True))):
        reason = F.when(F.col(flag).isNull(), rule).otherwise(reason)

    def of(rule: str) -> tuple[Column, Column]:
        held = F.lit(True) if rule == READ else reason == rule
        return F.sum(F.when(held, F.col("_rows"))), F.sum(F.when(held, F.col("_amount")))

    return _ledger(judged, table, {rule: of(rule) for rule in (READ, SUMMED, *lines.needs, NO_BOOKING)})


def input_contract(
    keys: Mapping[str, tuple[DataFrame, Sequence[str]]], lines: Mapping[str, Lines], tax: Lookup, bookings: Lookup
) -> DataFrame:
    """(table_name, rule, rows, amount) for every table and rule; a contract that holds has zeros.

    ``keys`` names the tables that must hold one row per key, ``lines`` those whose rows must find tax rows and a
    booking. Every table is read once.
    """
    parts = [key_rules(frame, name, key) for name, (frame, key) in keys.items()]
    parts += [line_rules(one, name, tax, bookings) for name, one in lines.items()]
    return reduce(DataFrame.unionByName, parts)
