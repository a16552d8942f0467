"""Fixed-point amounts, exact rounding, ratios and percentage changes.

Money and quantities are summed as whole numbers (BIGINT) of 10**-scale: such sums are exact whatever the
order in which partitions are merged, and cheap. Only a sum is rounded to two decimals, never a line. A value
or sum that does not fit, beyond 9e18 of these units, fails instead of wrapping around. Quotients keep enough digits for a half-away-from-zero rounding of the true value; results are
doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(20,0)"
WIDE = "decimal(24,4)"
FRACTION = "decimal(38,12)"


def decimals_of(kind: str) -> int | None:
    """How many decimals a SQL type holds exactly; None for binary floating point."""
    if kind in ("double", "float"):
        return None
    return int(kind.rstrip(")").split(",")[1]) if kind.startswith("decimal") else 0


def whole(value: Column, kind: str, scale: int) -> Column:
    """An amount of the given SQL type as a whole number of 10**-scale; what is finer is rounded away."""
    if decimals_of(kind) is None:
        return F.rint(value * float(10**scale)).cast("bigint")
    return (F.round(value.cast("decimal(38,18)"), scale) * F.lit(10**scale).cast("decimal(19,0)")).cast("bigint")


def units(total: Column, scale: int) -> Column:
    """A sum of 10**-scale as a double, rounded to two decimals, half away from zero."""
    if scale <= 2:
        return total / F.lit(float(10**scale))
    return F.round(total.cast(WHOLE) / F.lit(10**scale).cast("decimal(19,0)"), 2).cast("double")


def _percent(fraction: Column) -> Column:
    # Rounding the fraction itself keeps all its digits; times 100 first would cost some.
    return (F.round(fraction, 4) * 100).cast("double")


def _not_zero(value: Column, kind: str) -> Column:
    return F.nullif(value.cast(kind), F.lit(0).cast(kind))


def quotient(numerator: Column, denominator: Column, kind: str = WHOLE) -> Column:
    """Unrounded quotient of two numbers that fit the kind; NULL where the denominator is zero."""
    return numerator.cast(kind) / _not_zero(denominator, kind)


def safe_ratio(numerator: Column, denominator: Column, digits: int = 2, kind: str = WHOLE) -> Column:
    return F.round(quotient(numerator, denominator, kind), digits).cast("double")


def units_per(total: Column, count: Column, scale: int) -> Column:
    """A sum of 10**-scale per counted thing."""
    return safe_ratio(total, count.cast(WHOLE) * F.lit(10**scale).cast("decimal(19,0)"), kind="decimal(38,0)")


def pct_change(current: Column, previous: Column, kind: str = WHOLE) -> Column:
    """Change from previous to current in percent; NULL where previous is zero."""
    now, before = current.cast(kind), previous.cast(kind)
    return _percent((now - before) / _not_zero(before, kind))


def pct_change_of_quotients(
    top: Column, bottom: Column, top_before: Column, bottom_before: Column
) -> Column:
    """Change from top_before / bottom_before to top / bottom in percent."""
    now = top.cast("double") / _not_zero(bottom, "double")
    before = _not_zero(top_before, "double") / _not_zero(bottom_before, "double")
    return _percent((now / before - 1).cast(FRACTION))


def share_pct(part: Column, whole: Column) -> Column:
    return _percent(quotient(part, whole))
