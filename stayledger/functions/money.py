"""Money: embedded tax, service quantities, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for any booking total, and exact before a half-up rounding: a
# double such as 2.675 is below the tie it prints as.
EXACT = "decimal(28,6)"

# Decimals of EXACT: an amount has no more to round away.
EXACT_SCALE = 6


def tax_share(percent: Column) -> Column:
    """Part of a gross amount that is tax, ``1 - 1 / (1 + percent / 100)``.

    A rate of -100 percent leaves no net amount; the result is null, not an error.
    """
    return F.lit(1.0) - F.try_divide(F.lit(1.0), F.lit(1.0) + percent / F.lit(100.0))


def embedded_tax(gross: Column, percent: Column) -> Column:
    """Tax contained in a gross amount."""
    return gross * tax_share(percent)


def regime_amount(regime: Column, special: Column, general: Column) -> Column:
    """``special`` under the margin regime ``'E'``, ``general`` otherwise (a null regime included)."""
    return F.when(regime == "E", special).otherwise(general)


def sales_tax(line: dict[str, Column]) -> Column:
    """Sales tax of one service line, 0 when an amount it needs is missing."""
    margin = line["imp_margen_canal"]
    return F.coalesce(
        regime_amount(
            line["ind_tipo_regimen_fac"],
            margin * line["share_vta"],
            line["imp_venta"] * line["share_vta"] - (line["imp_venta"] - margin) * line["share_cpa"],
        ),
        F.lit(0.0),
    )


def cost_tax(line: dict[str, Column]) -> Column:
    """Cost tax of one service line, 0 when an amount it needs is missing."""
    margin = line["imp_margen_canco"]
    return F.coalesce(
        regime_amount(
            line["ind_tipo_regimen_con"],
            margin * line["share_vta"],
            (line["imp_coste"] + margin) * line["share_vta"] - line["imp_coste"] * line["share_cpa"],
        ),
        F.lit(0.0),
    )


def night_amount(
    start: Column,
    end: Column,
    units: Column,
    passengers: Column,
    unit_type: Column,
    per: Column,
    unit_amount: Column,
    number_days: Column | None = None,
) -> Column:
    """Amount of a dated service.

    Nights for unit type ``'N'``, days for ``'S'``, once for anything else, unless
    ``number_days`` is given; times passengers for ``'P'``, else times units.
    A service without both dates costs nothing.
    """
    nights = F.datediff(F.to_date(end), F.to_date(start))
    days = F.when(unit_type == "N", nights).when(unit_type == "S", nights + 1).otherwise(F.lit(1))
    if number_days is not None:
        days = F.coalesce(F.nullif(number_days, F.lit(0)), days)
    heads = F.when(per == "P", passengers).otherwise(units)
    return F.when(start.isNull() | end.isNull(), F.lit(0.0)).otherwise(
        unit_amount.cast("double") * days * heads
    )


def round_half_up(amount: Column, decimals: int) -> Column:
    """Round away from zero at a tie, on the exact decimal value."""
    return F.round(amount.cast(EXACT), decimals).cast(EXACT)


def round_by_decimals(amount: Column, decimals: Column) -> Column:
    """Round to a per-row number of decimals; unknown decimals leave the amount alone.

    ``round`` takes a literal scale only, hence one branch per scale that the type has. Negative decimals
    round to tens, hundreds and so on.
    """
    exact = amount.cast(EXACT)
    branches = F.when(decimals.isNull() | (decimals >= EXACT_SCALE), exact).when(decimals < 0, _round_to_tens(exact, -decimals))
    for scale in range(EXACT_SCALE):
        branches = branches.when(decimals == scale, round_half_up(amount, scale))
    return branches


def _round_to_tens(exact: Column, zeros: Column) -> Column:
    # Beyond 22 digits before the point every amount rounds to zero.
    unit = F.pow(F.lit(10.0), F.least(zeros, F.lit(23))).cast("decimal(24,0)")
    raised = F.abs(exact).cast("decimal(38,6)") + unit / 2
    return (F.signum(exact).cast("decimal(1,0)") * (raised - raised % unit)).cast(EXACT)
