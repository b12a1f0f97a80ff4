"""Exact decimal rounding for averages and percentages.

Decimal ``round`` in Spark is half away from zero, as PostgreSQL numeric is.
Averages are taken over inputs widened to ``decimal(20,8)``: the average itself is
rounded at scale 12, then to the digits wanted.  Twice rounded can differ from
once only if the exact average lies within 5e-13 below a half unit of the last digit,
which for inputs of scale 2 takes groups of over 10^9 rows.  The percentage over
listing is computed in whole numbers, so no intermediate rounding happens at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AVG_INPUT_TYPE = "decimal(20,8)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def avg_rounded(c: str | Column, digits: int) -> Column:
    """``round(avg(c), digits)`` as ``decimal(18, digits)``; nulls are ignored."""
    return F.round(F.avg(_c(c).cast(AVG_INPUT_TYPE)), digits).cast(f"decimal(18,{digits})")


def div_round_half_away(num: str | Column, den: str | Column) -> Column:
    """``num / den`` rounded half away from zero, for whole numbers.

    Uses SQL ``div`` (integral division, exact on longs); null when den is 0.
    """
    num, den = _c(num).cast("long"), _c(den).cast("long")
    size = F.abs(den)
    quotient = F.call_function("div", F.abs(num) * 2 + size, size * 2)
    return F.when(den != 0, (F.signum(num) * F.signum(den)).cast("long") * quotient)


def pct_change_rounded(new: str | Column, base: str | Column, digits: int = 2) -> Column:
    """``round(100 * (new - base) / base, digits)`` exactly, for money (scale 2).

    Null when base is 0 (a zero listing price raises in ANSI SQL; we return null).
    """
    diff_cents = ((_c(new) - _c(base)) * 100).cast("long")
    base_cents = (_c(base) * 100).cast("long")
    scaled = div_round_half_away(diff_cents * (100 * 10 ** digits), base_cents)
    return (scaled.cast("decimal(20,0)") / F.lit(10 ** digits)).cast(f"decimal(18,{digits})")
