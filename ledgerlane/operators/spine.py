"""The trading calendar, and filling every portfolio up to it.

Calendars are broadcast and may be sorted in one task: a DATE column has no more
than 3.7 million distinct values (about 30 MB), whatever the size of the tables
the days came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.functions.clock import is_weekday
from ledgerlane.schemas import DATES


def calendar(span: DataFrame) -> DataFrame:
    """Every day of a one-row (first, last) table of dates; no day if they are null.

    The two dates are fetched once, as a calendar is read several times.
    """
    spark = span.sparkSession
    first, last = span.first()
    if first is None:
        return spark.createDataFrame([], DATES)
    days = spark.range((last - first).days + 1)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_value"))


def trading_days(dates: DataFrame) -> DataFrame:
    """Mondays to Fridays of the calendar, each once."""
    return dates.select("date_value").filter(is_weekday(F.col("date_value"))).distinct()


def with_previous_day(days: DataFrame) -> DataFrame:
    """Each trading day with the one before it."""
    before = Window.orderBy("date_value")
    return days.withColumn("previous_day", F.lag("date_value").over(before))


def spread_over_days(
    daily: DataFrame, days: DataFrame, is_first: Column, next_date: Column
) -> DataFrame:
    """Repeat each daily row for the trading days it stands for.

    A row stands for the days from its own date up to the day before the next
    row's; the first row also for all days before it. Every portfolio thus gets
    every trading day exactly once without a join on its keys: the dense result
    (portfolios x days) is produced map-side and never shuffled or sorted.
    """
    ends = days.agg(F.struct(F.min("date_value").alias("lo"), F.max("date_value").alias("hi")))
    from_own_date = F.greatest("date_now", F.col("_ends.lo"))
    bounded = (
        daily.withColumn("_ends", ends.scalar())
        .withColumn("_from", F.when(is_first, F.col("_ends.lo")).otherwise(from_own_date))
        .withColumn("_to", F.least(F.date_sub(next_date, 1), F.col("_ends.hi")))
        .filter(F.col("_from") <= F.col("_to"))
    )
    # Every run is non-empty by the filter above; the outer form spares the
    # optimizer's own emptiness test, which would build each sequence twice.
    # Days are numbered: a number is looked up by its place, where a date is hashed.
    run = F.sequence(F.unix_date("_from"), F.unix_date("_to"))
    numbered = with_previous_day(days).withColumn("_day", F.unix_date("date_value"))
    return bounded.withColumn("_day", F.explode_outer(run)).join(F.broadcast(numbered), "_day").drop(
        "_ends", "_from", "_to", "_day"
    )
