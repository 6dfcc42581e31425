"""Time expressions on zone-free timestamps and dates.

Nothing here depends on the session time zone: a reading taken at 13:30 is at
13:30 on every cluster.
"""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Distance between two neighbouring microseconds in a reading's order key. It
# is larger than the whole range of a 64-bit tie breaker, so a tie breaker can
# never reach into the next microsecond.
MICROSECOND_STRIDE = "100000000000000000000"


def instant(moment: datetime) -> Column:
    """A zone-free literal. F.lit(datetime) would pass through two time zones,
    the driver's and the session's."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def time_of_day(ts: Column) -> Column:
    """Interval since midnight (Spark's TIME type is off by default)."""
    return ts.cast("timestamp_ntz") - F.to_date(ts).cast("timestamp_ntz")


def micros_since_epoch(ts: Column) -> Column:
    """Microseconds since 1970 on the wall clock, as DECIMAL(18,0)."""
    seconds = (ts.cast("timestamp_ntz") - F.expr(EPOCH)).cast("interval second")
    return (seconds.cast("decimal(18,6)") * F.lit(1_000_000)).cast("decimal(18,0)")


def not_later_than(ts: Column, cutoff: time) -> Column:
    """True up to and including the cutoff."""
    since_midnight = timedelta(
        hours=cutoff.hour,
        minutes=cutoff.minute,
        seconds=cutoff.second,
        microseconds=cutoff.microsecond,
    )
    return time_of_day(ts) <= F.lit(since_midnight)


def is_weekday(day: Column) -> Column:
    """Monday to Friday; weekday() counts from Monday = 0 on every setting."""
    return F.weekday(day) < 5


def is_day_after_weekday(day: Column) -> Column:
    """Tuesday to Saturday: the days after Monday to Friday."""
    return F.weekday(day).between(1, 5)


def days_before(ts: Column, days: int) -> Column:
    """The instant exactly ``days`` times 24 hours earlier."""
    return ts - F.lit(timedelta(days=days))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Number of full 24-hour days from ``earlier`` to ``later``."""
    return F.extract(F.lit("DAY"), later - earlier)


def reading_order(ts: Column, tie_breaker: Column | None = None) -> Column:
    """One sortable value for "when", unique if (ts, tie_breaker) is.

    Without a tie breaker it is the timestamp itself. With one, both are packed
    into a single DECIMAL(38,0) instead of a struct: a decimal fits an
    updatable aggregation buffer, so max_by/min_by plan as HashAggregate,
    where a struct would force a sort of every input partition.
    """
    if tie_breaker is None:
        return ts
    stride = F.lit(MICROSECOND_STRIDE).cast("decimal(21,0)")
    tie = F.coalesce(tie_breaker.cast("bigint"), F.lit(0))
    return (micros_since_epoch(ts) * stride + tie).cast("decimal(38,0)")
