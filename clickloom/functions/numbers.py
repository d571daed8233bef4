"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_double(c: Column, scale: int) -> Column:
    """Round a double half-up."""
    return F.round(c, scale)


def share(part: Column, whole: Column, scale: int = 2) -> Column:
    """`part / whole`, half-up at `scale` decimals, in whole-number arithmetic.

    Exact for every count, so that two engines agree on it. Null when `whole` is 0.
    """
    unit = 10**scale
    n, d = part.cast("bigint"), F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    units = F.call_function("div", n * F.lit(2 * unit) + d, d * F.lit(2))
    return units.cast("double") / F.lit(float(unit))
