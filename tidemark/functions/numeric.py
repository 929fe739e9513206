"""Arithmetic helpers, all plain Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round a double half-to-even the way NumPy does: scale, ``rint``, unscale."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """``numerator / denominator`` as a double; ``default`` on a zero or null denominator."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(quotient, F.lit(float(default)))


def to_units(amount: Column, decimals: int | None) -> Column:
    """Amounts as whole units of ``10**-decimals``.

    Adding integers gives the same total under every partitioning; adding
    doubles does not. ``None`` leaves the amount a double, for sources whose
    values have no fixed number of decimals.
    """
    if decimals is None:
        return amount.cast("double")
    return F.round(amount.cast("double") * F.lit(float(10**decimals))).cast("bigint")


def from_units(units: Column, decimals: int | None) -> Column:
    if decimals is None:
        return units.cast("double")
    return units.cast("double") / F.lit(float(10**decimals))
