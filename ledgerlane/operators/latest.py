"""Latest-row and first/last-reading operators.

All of them are plain aggregates, so every map task first shrinks its own rows
to one per group. A portfolio holding a third of all readings therefore
reaches the shuffle as one row per task, never as one long group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.clock import not_later_than, reading_order


def order_of(df: DataFrame, ts: str, tie_breaker: str | None) -> Column:
    """Order key of a reading; the tie breaker is used if the table has it."""
    has_tie_breaker = tie_breaker is not None and tie_breaker in df.columns
    return reading_order(F.col(ts), F.col(tie_breaker) if has_tie_breaker else None)


def latest_row(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "datetime_now",
    tie_breaker: str | None = "primary_key",
) -> DataFrame:
    """The newest row of every key, all columns kept; no row for no input.

    Columns are picked one by one at the greatest order, which must be unique
    in a key. Those buffers are updated in place by a hash aggregation (text
    columns are sorted), and a column nobody reads is not picked at all.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = df.withColumn("_order", order_of(df, ts, tie_breaker)).filter(F.col(ts).isNotNull())
    picks = [c.alias(name) for name, c in zip(rest, pick_latest(rest, "_order"), strict=True)]
    newest = ordered.groupBy(*keys).agg(F.max("_order").alias("_newest"), *picks)
    return newest.filter(F.col("_newest").isNotNull()).select(*keys, *rest)


def wide_balances(
    readings: DataFrame,
    keys: Sequence[str],
    account: str,
    balance: Column,
    order: Column,
    columns: Mapping[str, str],
) -> DataFrame:
    """Latest balance of each listed account, one wide row per key.

    Last-wins deduplication and pivot in a single aggregation: ``columns`` maps
    output column -> account value, and the order of the mapping is the order
    of the columns. Accounts that are not listed are ignored.
    """
    shaped = readings.select(
        *keys,
        F.col(account).alias("_account"),
        balance.alias("_balance"),
        order.alias("_order"),
    )
    return shaped.groupBy(*keys).agg(
        *[
            F.max_by("_balance", F.when(F.col("_account") == wanted, F.col("_order"))).alias(name)
            for name, wanted in columns.items()
        ]
    )


def morning_readings(
    readings: DataFrame,
    value: str,
    cutoff: time,
    keys: Sequence[str],
    tie_breaker: str | None = "primary_key",
    all_days: bool = False,
    times: bool = False,
) -> DataFrame:
    """First and last value of each day among readings up to the cutoff.

    The two picks share one aggregation. A day without any morning reading is
    left out, or kept with nulls if ``all_days`` is set (so that a portfolio
    which only has afternoon readings is not lost). With ``times`` the capture
    times of the picked readings stand beside them.
    """
    early = not_later_than(F.col("datetime_now"), cutoff)
    shaped = readings.withColumn(
        "_order", F.when(early, order_of(readings, "datetime_now", tie_breaker))
    )
    picks = [
        F.max_by("_value", "_order").alias("last_value"),
        F.min_by("_value", "_order").alias("first_value"),
    ]
    extra = []
    if times:
        # The order goes by time first, so the picked readings have these times.
        extra = [F.when(early, F.col("datetime_now")).alias("_time")]
        picks += [F.max("_time").alias("last_time"), F.min("_time").alias("first_time")]
    shaped = shaped.select(*keys, "date_now", F.expr(value).alias("_value"), "_order", *extra)
    if not all_days:
        shaped = shaped.filter(F.col("_order").isNotNull())
    return shaped.groupBy(*keys, "date_now").agg(*picks)


def pick_latest(columns: Iterable[str], order: str, where: Column | None = None) -> list[Column]:
    """Each column's value at the greatest order among the rows that qualify.

    The order is unique, so all picked values come from the same row.
    """
    key = F.col(order) if where is None else F.when(where, F.col(order))
    return [F.max_by(c, key) for c in columns]
