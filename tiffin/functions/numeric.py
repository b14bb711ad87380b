"""Exact rounding helpers.

KPIs are reported rounded (1 or 2 decimals).  Rounding an IEEE average is
sensitive to summation order, so every rounded ratio here is computed from
integer numerators and denominators with round-half-up integer arithmetic,
which gives the same digits on every engine and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(a, b) -> Column:
    """Exact integer quotient towards zero as decimal(38,0); null when b = 0.

    The remainder goes first, so the decimal division that is left has no
    fraction to round.  (``div`` would do, but its result must fit a bigint.)
    """
    n, d = _c(a).cast("decimal(38,0)"), F.nullif(_c(b).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return ((n - n % d) / d).cast("decimal(38,0)")


def round_ratio(num, den, digits: int, scale: int = 1) -> Column:
    """round_half_up(scale * num / den, digits) as double; null when den = 0.

    ``num`` and ``den`` must be integral (counts, cents, tenths).  Works for
    negative numerators (rounds half away from zero).
    """
    n = _c(num).cast("decimal(38,0)") * F.lit(scale * 10 ** digits)
    d = _c(den).cast("decimal(38,0)")
    q = idiv(F.abs(n) * 2 + d, d * 2)
    signed = F.when(n < 0, -q).otherwise(q)
    return F.when(d != 0, signed.cast("double") / F.lit(float(10 ** digits)))


def cents(x) -> Column:
    """Money (decimal with 2 places) as an exact integer number of cents."""
    return (_c(x).cast("decimal(38,2)") * 100).cast("decimal(38,0)")


def money_avg(sum_cents, n) -> Column:
    """Average of money rounded half-up to cents, as decimal(18,2)."""
    s = _c(sum_cents).cast("decimal(38,0)")
    d = _c(n).cast("decimal(38,0)")
    q = idiv(F.abs(s) * 2 + d, d * 2)
    signed = F.when(s < 0, -q).otherwise(q)
    return F.when(d != 0, (signed / 100).cast("decimal(18,2)"))


def money(x) -> Column:
    return _c(x).cast("decimal(18,2)")


def money_sum(x) -> Column:
    """Sum of money as decimal(38,2) (exact; same type in every engine)."""
    return F.sum(_c(x)).cast("decimal(38,2)")
