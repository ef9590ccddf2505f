"""Column expressions shared by the operators. All stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.config import DEFAULTS

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: ColumnOrName) -> Column:
    return as_col(c).cast("double")


def mean(c: ColumnOrName) -> Column:
    """Average taken from the exact sum and count, so the result does not depend on merge order."""
    return F.sum(as_col(c)).cast("double") / F.nullif(F.count(as_col(c)), F.lit(0))


def rnd(c: ColumnOrName, digits: int) -> Column:
    return F.round(dbl(c), digits)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is zero."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def ratio_or_zero(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den where den is positive, otherwise 0."""
    return F.when(dbl(den) > 0, dbl(num) / dbl(den)).otherwise(F.lit(0.0))


def clamp(c: ColumnOrName, low: float, high: float) -> Column:
    c = as_col(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def to_id(c: ColumnOrName) -> Column:
    """Integer id from text such as ``17`` or ``17.0``, exact over all of bigint; anything else is NULL."""
    number = as_col(c).try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def day(c: ColumnOrName) -> Column:
    return F.to_date(as_col(c))


def is_weekend(ts: ColumnOrName, weekend_days: Sequence[int] = DEFAULTS.weekend_days) -> Column:
    """Weekday test with Monday = 0."""
    return F.weekday(as_col(ts)).isin(*weekend_days)


def is_peak_hour(ts: ColumnOrName) -> Column:
    return F.hour(as_col(ts)).between(DEFAULTS.peak_first_hour, DEFAULTS.peak_last_hour)


def time_of_day(ts: ColumnOrName) -> Column:
    h = F.hour(as_col(ts))
    return (
        F.when(h.between(5, 11), "morning")
        .when(h.between(12, 16), "afternoon")
        .when(h.between(17, 21), "evening")
        .otherwise("night")
    )


def day_name(ts: ColumnOrName) -> Column:
    return F.date_format(as_col(ts), "EEEE")


def elapsed_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole 24-hour periods from start to end (not calendar days)."""
    seconds = F.unix_micros(as_col(end).cast("timestamp")) - F.unix_micros(as_col(start).cast("timestamp"))
    return F.floor(seconds / F.lit(86_400_000_000)).cast("bigint")


def tier(c: ColumnOrName, cuts: Sequence[tuple[float, str]], lowest: str, unknown: str | None = None) -> Column:
    """Label by descending cut-offs: the first cut the value reaches wins."""
    c = as_col(c)
    expr = F.when(c.isNull(), F.lit(unknown))
    for limit, label in cuts:
        expr = expr.when(c >= limit, F.lit(label))
    return expr.otherwise(F.lit(lowest))


def plausible_date(ts: ColumnOrName, as_of: str) -> Column:
    """Known, not after ``as_of`` and not before 2000."""
    ts = as_col(ts)
    return F.coalesce((ts <= F.lit(as_of).cast("timestamp")) & (F.year(ts) >= 2000), F.lit(False))


def normalised(c: ColumnOrName) -> Column:
    return F.lower(F.trim(as_col(c)))
