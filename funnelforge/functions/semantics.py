"""Column helpers that pin down SQL semantics which differ between engines.

All helpers return built-in Column expressions (JVM-side, codegen'd); none
of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColOrName = Column | str

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x: ColOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x: ColOrName, places: int) -> Column:
    """``round(x, n)`` on doubles the way the warehouse rounds: scale, round, unscale.

    Spark's ``round`` goes through the decimal text of the double (1.005 -> 1.01)
    while the reference engine rounds the binary value (1.005 -> 1.0).  Scaling
    first reproduces the latter; the result stays DOUBLE.
    """
    scale = float(10 ** places)
    return F.round(_c(x).cast("double") * F.lit(scale), 0) / F.lit(scale)


def hours_between(start: ColOrName, end: ColOrName) -> Column:
    """Number of hour boundaries crossed from ``start`` to ``end`` (00:59 -> 01:01 is 1).

    Equivalent to truncating both sides to the hour and diffing; unlike
    ``timestampdiff(HOUR)``, which counts whole elapsed hours.
    """
    return _epoch_hour(_c(end)) - _epoch_hour(_c(start))


_HOUR_US = 3_600_000_000


def _epoch_hour(ts: Column) -> Column:
    """floor((ts - epoch) / 1 hour) in exact integer arithmetic; zone free for NTZ."""
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))
    # exact while |ts| < 2^53 microseconds from the epoch (years 1685..2255)
    return F.floor(us / F.lit(_HOUR_US)).cast("bigint")


# A calendar date, alone or followed by hours and minutes at least; Spark would
# otherwise accept bare years ('2025'), times ('12:30') and bare hours
# ('2025-01-01T10') that the warehouse rejects.
_TS_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:$|[T ]\d{1,2}:\d{1,2})"
# The end of a day, which the warehouse reads as the next midnight.
_DAY_END = r"^\s*(\d{4}-\d{1,2}-\d{1,2})[T ]24:00(?::00(?:\.0*)?)?(?:$|[Z+ -])"


def try_timestamp(s: ColOrName) -> Column:
    """String -> TIMESTAMP_NTZ; NULL when unparseable (ISO 'T' and 'Z' accepted)."""
    s = _c(s)
    next_midnight = (F.regexp_extract(s, _DAY_END, 1).try_cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    return F.when(s.rlike(_DAY_END), next_midnight).when(s.rlike(_TS_SHAPE), s.try_cast("timestamp_ntz"))


def try_int_rounded(s: ColOrName) -> Column:
    """String -> INT rounding fractional text ('3.7' -> 4) instead of returning NULL."""
    return F.round(_c(s).try_cast("decimal(38,6)"), 0).try_cast("int")


def epoch_to_ts(seconds: ColOrName) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ in UTC, independent of the session time zone."""
    s = _c(seconds)
    return F.when(s.isNotNull(), F.timestamp_add("SECOND", s.cast("bigint"), F.expr(_EPOCH)))


def month_start(ts: ColOrName) -> Column:
    """First instant of the month of ``ts`` as TIMESTAMP_NTZ (time-zone free)."""
    return F.trunc(_c(ts).cast("date"), "MM").cast("timestamp_ntz")


def safe_div(num: ColOrName, den: ColOrName) -> Column:
    """num / nullif(den, 0) as DOUBLE (ANSI division by zero would raise)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def cents_to_usd(cents: ColOrName) -> Column:
    """Integer cents -> DOUBLE dollars (``/ 100.0`` would give DECIMAL in Spark)."""
    return _c(cents).cast("double") / F.lit(100.0)


def first_element(arr: ColOrName) -> Column:
    """First array element or NULL when empty / NULL (``arr[0]`` throws under ANSI)."""
    return F.get(_c(arr), 0)


def email_domain(email: ColOrName) -> Column:
    """Text after the first '@' ('' when there is none), like ``split_part(e, '@', 2)``."""
    return F.split_part(_c(email), F.lit("@"), F.lit(2))
