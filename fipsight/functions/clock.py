"""Dates, durations and clock arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fipsight.functions.casts import _col, int_code

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(col, fmt: str = DEFAULT_TS_FORMAT) -> Column:
    """Text to timestamp; unparsable text gives NULL instead of an error (ANSI-safe)."""
    return F.try_to_timestamp(_col(col), F.lit(fmt))


def day_of_year0(ts) -> Column:
    """Zero-based day of the year: 1 January is 0, 29 February of a leap year is 59."""
    return F.dayofyear(_col(ts)) - F.lit(1)


def hours_between(start, end, digits: int = 2) -> Column:
    """Elapsed hours from ``start`` to ``end`` rounded half-to-even on ``digits`` decimals.

    Microsecond arithmetic, so the result does not depend on calendar or DST rules.
    """
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    scale = float(10 ** digits)
    return F.rint(micros / F.lit(3.6e9) * F.lit(scale)) / F.lit(scale)


def _clock_part(c, upper: int) -> Column:
    v = int_code(c)
    return F.when((v >= 0) & (v <= upper), v)


def response_minutes(arr_hour, arr_min, crash_hour, crash_min) -> Column:
    """Minutes from the crash clock to the arrival clock.

    An arrival hour smaller than the crash hour means the next day (+1440). Within the same hour
    an earlier arrival minute gives a negative difference, reported as its absolute value. Any
    part that is missing, not an integer, or out of range (hour > 23, minute > 59) gives NULL.
    """
    ah, am = _clock_part(arr_hour, 23), _clock_part(arr_min, 59)
    ch, cm = _clock_part(crash_hour, 23), _clock_part(crash_min, 59)
    diff = (ah * 60 + am) - (ch * 60 + cm) + F.when(ah < ch, F.lit(1440)).otherwise(F.lit(0))
    return F.abs(diff)
