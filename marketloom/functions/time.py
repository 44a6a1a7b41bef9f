"""Time expressions on zone-less timestamps; none depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(ts: Column | str) -> Column:
    """First instant of the month, as ``timestamp_ntz``."""
    return F.trunc(_c(ts), "MM").cast("timestamp_ntz")


def day_diff(later: Column | str, earlier: Column | str) -> Column:
    """Whole days of ``later - earlier``, truncated toward zero."""
    return F.extract(F.lit("DAY"), _c(later) - _c(earlier)).cast("bigint")


def to_seconds(interval: Column | str) -> Column:
    """Whole seconds of a day-time interval."""
    i = _c(interval)
    part = lambda unit: F.extract(F.lit(unit), i).cast("bigint")
    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def micros_between(later: Column | str, earlier: Column | str) -> Column:
    """``later - earlier`` in microseconds, as bigint."""
    d = _c(later) - _c(earlier)
    part = lambda unit: F.extract(F.lit(unit), d)
    whole = (
        part("DAY").cast("bigint") * 86400
        + part("HOUR").cast("bigint") * 3600
        + part("MINUTE").cast("bigint") * 60
    )
    return whole * F.lit(1000000) + (part("SECOND") * F.lit(1000000)).cast("bigint")


def epoch_diff(later: Column | str, earlier: Column | str, unit_seconds: float) -> Column:
    """Fractional ``(later - earlier)`` in units of ``unit_seconds``."""
    return micros_between(later, earlier).cast("double") / F.lit(unit_seconds * 1e6)
