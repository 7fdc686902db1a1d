"""Extras sold under an unprofitable campaign carry no tax or cost of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.operators.lookup import Lookup

EXTRA = ("seq_rec", "seq_reserva", "ord_extra")


def exclusion_keys(extra_bonds: DataFrame, discount_bonds: Lookup, campaigns: Lookup) -> DataFrame:
    """Distinct (office, booking, extra) keys whose bond belongs to an unprofitable campaign.

    Campaigns narrow the bonds before the bonds narrow the extras, and one bond
    may be behind any share of the extras: both joins only test membership.
    """
    unprofitable = campaigns.filter(F.col("ind_rentabilidad") == "N").select("cod_campana", "cod_interface")
    bonds = unprofitable.join(discount_bonds.frame, ["cod_campana", "cod_interface"], "left_semi")
    bonds = discount_bonds.of(bonds.select("num_bono", "cod_interface"))
    excluded = bonds.join(extra_bonds, ["num_bono", "cod_interface"], "left_semi")
    return excluded.select(
        F.col("grec_seq_rec").alias("seq_rec"), F.col("rres_seq_reserva").alias("seq_reserva"), "ord_extra"
    ).distinct()


def without_excluded(rows: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Rows whose (office, booking, extra) is not excluded; rows without an extra number always stay.

    Give it rows already summed by that key: then neither side repeats a key and
    none can be hot.
    """
    return rows.join(exclusions, list(EXTRA), "left_anti")
