"""Gains and losses per trading day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.config import ModelConfig
from ledgerlane.functions.clock import is_day_after_weekday, is_weekday
from ledgerlane.operators.latest import morning_readings
from ledgerlane.operators.spine import spread_over_days, trading_days


def gains_losses(account_data: DataFrame, dates: DataFrame, config: ModelConfig) -> DataFrame:
    """Per trading day: value before trading, value the next morning, difference.

    Before trading is the day's last reading up to the cutoff, taken on a
    weekday; after trading is the first reading of the following calendar day
    (for a Friday that is Saturday's), taken on a Tuesday to Saturday. The
    weekday is that of the reading's own time: a reading whose ``date_now`` is
    of another day than its ``datetime_now`` is picked by the one and judged by
    the other. The previous day is the previous calendar row, so a day
    without readings gives null and is not skipped.

    Two shuffles, both of daily rows only: (portfolio, date) for the picks and
    portfolio for their neighbours. A difference exists only where two daily
    rows are one day apart, so everything is known before the calendar is
    filled, and the filled rows stay where they are.
    """
    keys = list(config.keys)
    days = trading_days(dates)
    daily = morning_readings(
        account_data,
        config.investment_expr,
        config.cutoff,
        keys,
        config.tie_breaker,
        all_days=True,
        times=True,
    )
    daily = taken_on_trading_days(daily).drop("last_time", "first_time")
    if keys:
        # Adaptive execution merges partitions by their bytes, but here a few
        # bytes can grow into whole calendars. A given number is left alone.
        partitions = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        daily = daily.repartition(partitions, *keys)
    else:
        daily = daily.unionByName(_before_calendar(days), allowMissingColumns=True)

    filled = spread_over_days(
        _with_neighbours(daily, days, keys), days, F.col("_is_first"), F.col("_next.date_now")
    )
    is_own = F.col("date_value") == F.col("date_now")
    day_after = F.date_add("date_value", 1)
    return filled.select(
        *keys,
        "date_value",
        F.when(is_own, F.col("last_value")).alias("pre_investment"),
        F.when(day_after == F.col("_next.date_now"), F.col("_next.first_value"))
        .when(day_after == F.col("date_now"), F.col("first_value"))
        .alias("post_investment"),
        F.when(is_own, F.col("_gain")).alias("gains_losses"),
        F.when(
            F.col("previous_day") == F.col("_last_open.date_now"), F.col("_last_open._gain")
        ).alias("previous_day_gains"),
    )


def taken_on_trading_days(daily: DataFrame) -> DataFrame:
    """Daily rows without the values of readings that were taken on other weekdays."""
    return daily.withColumns({
        "last_value": F.when(is_weekday(F.col("last_time")), F.col("last_value")),
        "first_value": F.when(is_day_after_weekday(F.col("first_time")), F.col("first_value")),
    })


def _with_neighbours(daily: DataFrame, days: DataFrame, keys: list[str]) -> DataFrame:
    """Daily rows with the next one, and the last earlier one on a trading day.

    There is one row per key and date, so a window partition holds at most one
    row per calendar day, however many readings a portfolio has.
    """
    open_days = days.select(F.col("date_value").alias("date_now"), F.lit(True).alias("_open"))
    by_date = Window.partitionBy(*keys).orderBy("date_now")
    earlier = by_date.rowsBetween(Window.unboundedPreceding, -1)
    next_morning = F.col("_next.date_now") == F.date_add("date_now", 1)
    return (
        daily.join(F.broadcast(open_days), "date_now", "left")
        .withColumn("_is_first", F.row_number().over(by_date) == 1)
        .withColumn("_next", F.lead(F.struct("date_now", "first_value")).over(by_date))
        .withColumn(
            "_gain", F.when(next_morning, F.col("_next.first_value") - F.col("last_value"))
        )
        .withColumn(
            "_last_open",
            F.last(
                F.when(F.col("_open"), F.struct("date_now", "_gain")), ignorenulls=True
            ).over(earlier),
        )
    )


def _before_calendar(days: DataFrame) -> DataFrame:
    """A row without values that stands for the whole calendar: without keys it
    is shown even if there is no reading at all."""
    return days.agg(F.date_sub(F.min("date_value"), 2).alias("date_now"))
