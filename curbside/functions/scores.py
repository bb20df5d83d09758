"""Column functions for possibilities, rounding and the texts shown to users."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbside.schemas import MISSING_LABEL, OCCUPANCY_LABEL


def possibility(x: Column, n: Column | int) -> Column:
    """Share of observed days, at most 1, half-even to two decimals.

    NaN counts as missing. Rounding works on the decimal form of ``x / n``, so
    it can differ from binary rounding only where ``x / n`` ends on half a cent.
    """
    n = n if isinstance(n, Column) else F.lit(n)
    x = F.nanvl(x.cast("double"), F.lit(None).cast("double"))
    return F.when(x >= n, F.lit(1.0)).otherwise(F.bround(x / n, 2))


def round_half_even(value: Column) -> Column:
    """Nearest whole number, ties to the even one."""
    return F.bround(value, 0).cast("long")


def text_or_none(value: Column) -> Column:
    """Value as text, with the missing-value text for NULL."""
    return F.coalesce(value.cast("string"), F.lit(MISSING_LABEL))


def ratio_label(part: Column, total: Column) -> Column:
    """``part/total`` as text."""
    return F.concat(text_or_none(part), F.lit("/"), text_or_none(total))


def occupancy_label(part: Column, total: Column) -> Column:
    """The line shown at a destination."""
    return F.concat(F.lit(OCCUPANCY_LABEL), ratio_label(part, total))
