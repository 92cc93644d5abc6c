"""Row-level trip expressions (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiertrip.functions.numeric import round_value_fast


def whole_seconds_to_minutes(seconds: Column) -> Column:
    """``round(seconds / 60.0, 2)``, half up, for a whole number of seconds, without decimals.

    100 * s / 60 = 5s / 3 has fractional part 0, 1/3 or 2/3, never a tie, so half-up rounding is
    ``floor((10s + 3) / 6)`` hundredths, and ``k / 100.0`` is the double nearest to that value, as
    Spark's ``round`` returns. 10s + 3 is exact in a double for |s| below 2^49 seconds, and the
    quotient is at least 1/6 from an integer, so the division cannot move the floor. Absurd values
    beyond (the rules reject them) come out approximate and never overflow. Spark's ``round`` on a
    double goes through a BigDecimal per row; this stays in primitive arithmetic, which matters
    because Catalyst inlines the duration into every predicate of the sanity filter."""
    return F.floor((seconds.cast("double") * F.lit(10.0) + F.lit(3.0)) / F.lit(6.0)) / F.lit(100.0)


def duration_minutes(trip_seconds: Column) -> Column:
    """Trip duration in minutes, 2 dp; ``trip_time`` is whole seconds (bigint in RAW_TRIP)."""
    return whole_seconds_to_minutes(trip_seconds)


def raw_speed(miles: Column, duration_min: Column) -> Column:
    """Speed from the *rounded* duration, not rounded itself; NULL unless duration > 0 (guarded for ANSI mode)."""
    return F.when(duration_min > 0, miles / (duration_min / F.lit(60.0)))


def speed_mph(miles: Column, duration_min: Column) -> Column:
    """:func:`raw_speed` rounded as Spark's ``round`` does, without its per-row BigDecimal (``round_value_fast``)."""
    return round_value_fast(raw_speed(miles, duration_min), 2)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole-second epoch difference in minutes, 2 dp; NULL when ``earlier`` is NULL."""
    return F.when(earlier.isNotNull(),
                  whole_seconds_to_minutes(F.unix_timestamp(later) - F.unix_timestamp(earlier)))


def weekend_flag(ts: Column) -> Column:
    """1 on Sunday (dayofweek 1) and Saturday (7), else 0."""
    return F.when(F.dayofweek(ts).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def yes_flag(flag: Column) -> Column:
    """1 when the Y/N flag is 'Y'; 0 for 'N', anything else and NULL."""
    return F.when(flag == F.lit("Y"), F.lit(1)).otherwise(F.lit(0))


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
