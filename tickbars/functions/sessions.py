"""The trading week as column predicates.

Weekdays and minutes come from epoch arithmetic, so results do not depend on
the session time zone.  Monday is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
FRIDAY, SATURDAY, SUNDAY = 4, 5, 6

# Session edges in minutes after midnight UTC, and their tolerance.
WEEK_CLOSE = 22 * 60
BREAK_START = 22 * 60
BREAK_END = 23 * 60
TOLERANCE = 15

# Minutes without a new bar, and the status texts.
HEALTHY_BELOW = 20
DELAYED_UP_TO = 60
OPEN_LABEL = "Live"
CLOSED_LABEL = "Markets closed"
CLOSED_DETAIL = "XAUUSD reopens Sunday 22:00 UTC"


def weekday_of_seconds(seconds: Column) -> Column:
    """Weekday of an epoch second.  1970-01-01 was a Thursday (3)."""
    return F.pmod(F.floor(seconds / F.lit(DAY)) + F.lit(3), F.lit(7))


def weekday(ts: Column) -> Column:
    return weekday_of_seconds(F.unix_seconds(ts))


def is_weekday(ts: Column) -> Column:
    return weekday(ts) < SATURDAY


def minute_of_day(ts: Column) -> Column:
    return F.floor(F.pmod(F.unix_seconds(ts), F.lit(DAY)) / F.lit(60))


def near(minute: Column, target: int, tolerance: int = TOLERANCE) -> Column:
    """Within *tolerance* minutes of *target* on the 24-hour circle, ends included."""
    apart = F.abs(minute - F.lit(target))
    return F.least(apart, F.lit(1440) - apart) <= tolerance


def expected_gap(start: Column, end: Column) -> Column:
    """Whether ``[start, end)`` is a known closure: the weekend or the daily break."""
    opens_at, resumes_at = minute_of_day(start), minute_of_day(end)
    same_day = F.floor(F.unix_seconds(start) / F.lit(DAY)) == F.floor(F.unix_seconds(end) / F.lit(DAY))
    weekend = (weekday(start) == FRIDAY) & near(opens_at, WEEK_CLOSE) & (weekday(end) >= SATURDAY)
    daily = same_day & near(opens_at, BREAK_START) & near(resumes_at, BREAK_END)
    return F.coalesce(weekend | daily, F.lit(False))


def market_open(now: Column) -> Column:
    """Open from Sunday 22:00 to Friday 22:00 UTC, without tolerance."""
    day, minute = weekday(now), minute_of_day(now)
    after_close = (day == FRIDAY) & (minute >= WEEK_CLOSE)
    before_open = (day == SUNDAY) & (minute < WEEK_CLOSE)
    return ~((day == SATURDAY) | after_close | before_open)


def market_status(now: Column) -> Column:
    """``struct(open, label, detail)`` for display."""
    is_open = market_open(now)
    return F.struct(
        is_open.alias("open"),
        F.when(is_open, OPEN_LABEL).otherwise(CLOSED_LABEL).alias("label"),
        F.when(is_open, "").otherwise(CLOSED_DETAIL).alias("detail"),
    )


def health_level(minutes: Column, is_open: Column) -> Column:
    """closed / unknown / healthy / delayed / stale from the age of the newest bar."""
    return (
        F.when(~is_open, "closed")
        .when(minutes.isNull(), "unknown")
        .when(minutes < HEALTHY_BELOW, "healthy")
        .when(minutes <= DELAYED_UP_TO, "delayed")
        .otherwise("stale")
    )
