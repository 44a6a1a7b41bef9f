"""Exact arithmetic.

Money stays decimal from the scan to the report.  Averages are decimals too
(exact sum, one division, rounded half-up), so a result does not depend on the
order in which partitions are merged, and rounding ties behave as on paper.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Col) -> Column:
    """Cast raw (possibly text) input to the two-digit money type."""
    return _c(c).cast("decimal(10,2)")


def total(c: Col) -> Column:
    """Sum of a money column with a fixed result type."""
    return F.sum(_c(c)).cast("decimal(20,2)")


def mean(c: Col, digits: int = 2) -> Column:
    """Average of a numeric column as ``decimal(24,6)``.

    ``digits`` is the number of decimals the input carries (2 for money and
    integers, 6 for columns that are averages themselves)."""
    return F.avg(_c(c).cast(f"decimal({18 + digits},{digits})")).cast("decimal(24,6)")


def cents(c: Col) -> Column:
    """Money as a whole number of cents, which sums as fast as an integer."""
    return (_c(c) * F.lit(100).cast("decimal(3,0)")).cast("bigint")


def from_cents(c: Col) -> Column:
    """Back to money."""
    unit = F.lit("0.01").cast("decimal(3,2)")
    return (_c(c).cast("decimal(18,0)") * unit).cast("decimal(20,2)")


def weighted_mean(weight: Col, x: Col) -> Column:
    """Mean of an integer column where each row stands for ``weight`` source
    rows; exact, ``decimal(24,6)``.  Rows with NULL ``x`` do not count.

    The sums are integers (an overflow is an error, never a wrong figure)."""
    weight, x = _c(weight), _c(x)
    num = F.sum(weight * x).cast("decimal(22,0)")
    den = F.sum(F.when(x.isNotNull(), weight)).cast("decimal(18,0)")
    return F.try_divide(num, den).cast("decimal(24,6)")


def weighted_mean_micros(weight: Col, micros: Col, unit: int) -> Column:
    """``weighted_mean`` of microseconds in units of ``unit`` microseconds.
    Seconds and the rest are summed apart, so that the integers stay small."""
    weight, micros = _c(weight), _c(micros)
    second = F.lit(1_000_000)
    whole = F.floor(micros / second).cast("bigint")
    num = F.sum(weight * whole).cast("decimal(20,0)") * F.lit(1_000_000).cast(
        "decimal(7,0)"
    ) + F.sum(weight * (micros - whole * second)).cast("decimal(20,0)")
    den = F.sum(F.when(micros.isNotNull(), weight)).cast("decimal(16,0)") * F.lit(
        unit
    ).cast("decimal(12,0)")
    return F.try_divide(num.cast("decimal(32,0)"), den.cast("decimal(32,0)")).cast(
        "decimal(24,6)"
    )


def mean_over_all(df, c: Col) -> Column:
    """``avg(c) over ()`` as an uncorrelated scalar subquery of doubles: one
    partial aggregate, no single-partition window."""
    c = _c(c)
    return df.agg((F.sum(c).cast("double") / F.count(c)).alias("m")).scalar()


def ratio(num: Col, den: Col, digits: int = 2) -> Column:
    """``round(num / nullif(den, 0), digits)`` in exact decimals, half-up."""
    q = F.try_divide(_c(num).cast("decimal(26,6)"), _c(den).cast("decimal(22,2)"))
    return F.round(q, digits).cast(f"decimal(24,{digits})")


def pct(num: Col, den: Col, digits: int = 2) -> Column:
    """``num / den * 100`` rounded half-up; NULL for a zero divisor."""
    q = F.try_divide(
        _c(num).cast("decimal(26,6)") * F.lit(100), _c(den).cast("decimal(22,2)")
    )
    return F.round(q, digits).cast(f"decimal(24,{digits})")


def sample_stddev(n: Col, s: Col, ss: Col) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    The numerator ``n*ss - s*s`` is an exact decimal, so nothing cancels; the
    three inputs merge across partial aggregates.  NULL when ``n < 2``."""
    n, s, ss = _c(n), _c(s), _c(ss)
    num = n.cast("decimal(14,0)") * ss.cast("decimal(34,4)") - s.cast(
        "decimal(18,2)"
    ) * s.cast("decimal(18,2)")
    nd = n.cast("double")
    return F.when(
        n > 1, F.sqrt(num.cast("double") / (nd * (nd - 1))).cast("decimal(24,6)")
    )


def guarded_corr(x: Col, y: Col) -> Column:
    """``corr(x, y)`` that is NULL, not an error, when a side has no variance."""
    x, y = _c(x), _c(y)
    both = x.isNotNull() & y.isNotNull()
    flat = F.min(F.when(both, x)).eqNullSafe(F.max(F.when(both, x))) | F.min(
        F.when(both, y)
    ).eqNullSafe(F.max(F.when(both, y)))
    xd, yd = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    var = F.var_pop(xd) * F.var_pop(yd)
    return F.when(~flat, F.try_divide(F.covar_pop(xd, yd), F.sqrt(var)))
