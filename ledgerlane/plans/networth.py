"""Net worth over time, and now against earlier."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.config import ModelConfig
from ledgerlane.functions.clock import days_before
from ledgerlane.operators.latest import order_of, pick_latest
from ledgerlane.sources.warehouse import read_table, write_model

AMOUNTS = ("networth", "investment_amount")
LABEL = "date_stamp"


def networth(
    networth_historical: DataFrame, account_data: DataFrame, config: ModelConfig
) -> DataFrame:
    """History and snapshots as one series; duplicates are kept. No shuffle."""
    carried = [*config.keys]
    if config.tie_breaker is not None:
        carried.append(config.tie_breaker)
    stamps = ["datetime_now AS datetime_stamp", "date_now AS date_stamp"]
    past = networth_historical.selectExpr(
        *carried,
        *stamps,
        "CAST(networth AS DECIMAL(18,2)) AS networth",
        f"CAST(({config.pre_investment_expr}) AS DECIMAL(18,2)) AS investment_amount",
    )
    current = account_data.selectExpr(
        *carried,
        *stamps,
        f"CAST(({config.networth_expr}) AS DECIMAL(18,2)) AS networth",
        f"CAST(({config.investment_expr}) AS DECIMAL(18,2)) AS investment_amount",
    )
    return past.unionByName(current)


def daily_networth(series: DataFrame, config: ModelConfig) -> DataFrame:
    """The series' newest reading per portfolio and date label.

    Next to it stand the label's first instant and the portfolio's newest one.
    One row per calendar day is left of however many readings, combined
    map-side, so the window partition that finds the newest instant is bounded
    by the calendar.
    """
    keys = list(config.keys)
    ordered = _with_order(series, config)
    return (
        ordered.groupBy(*keys, LABEL)
        .agg(
            F.min("datetime_stamp").alias("label_start"),
            F.max("datetime_stamp").alias("datetime_stamp"),
            F.max("reading_order").alias("reading_order"),
            *[c.alias(a) for a, c in zip(AMOUNTS, pick_latest(AMOUNTS, "reading_order"))],
        )
        .withColumn("newest", F.max("datetime_stamp").over(Window.partitionBy(*keys)))
    )


def networth_comparison(series: DataFrame, config: ModelConfig, folder: str) -> DataFrame:
    """Latest net worth, and the latest at least N whole days before it.

    "N days before" depends on each portfolio's newest reading, so a direct
    solution would bring the whole series together by portfolio. Instead the
    series is first shrunk to daily rows, stored in ``folder`` because the
    steps after it read them several times. For nearly all date labels the
    newest reading alone settles every age, as all of the label lies on one
    side of the age limit. Only a label that a limit cuts in two, at most a few
    per portfolio, needs its single readings: their dates filter the series
    where it lies (and prune a table partitioned by date), and what is left is
    joined on (portfolio, date label): a shuffle of just those days, or none
    where adaptive execution finds the labels small enough to broadcast.

    With no keys the result is one row, of nulls if the series is empty.
    """
    keys = list(config.keys)
    shrunk = daily_networth(series, config)
    write_model(shrunk, folder)
    daily = read_table(series.sparkSession, folder, shrunk.schema)

    limits = {name: days_before(F.col("newest"), days) for name, days in config.ages.items()}
    is_cut = [
        (F.col("label_start") <= limit) & (F.col("datetime_stamp") > limit)
        for limit in limits.values()
    ]
    cut_labels = daily.filter(reduce(or_, is_cut)).select(*keys, LABEL, "newest")

    candidate = [*keys, "datetime_stamp", "newest", "reading_order", *AMOUNTS]
    candidates = daily.select(*candidate).unionByName(
        _readings_of(_with_order(series, config), cut_labels, keys).select(*candidate)
    )

    conditions = {"now": None}
    conditions.update({name: F.col("datetime_stamp") <= limit for name, limit in limits.items()})
    return candidates.groupBy(*keys).agg(
        *[
            pick_latest([amount], "reading_order", where)[0].alias(f"{amount}_{name}")
            for amount in AMOUNTS
            for name, where in conditions.items()
        ]
    )


def _with_order(series: DataFrame, config: ModelConfig) -> DataFrame:
    order = order_of(series, "datetime_stamp", config.tie_breaker)
    return series.withColumn("reading_order", order).select(
        *config.keys, LABEL, "datetime_stamp", "reading_order", *AMOUNTS
    )


def _readings_of(ordered: DataFrame, cut_labels: DataFrame, keys: list[str]) -> DataFrame:
    """All readings of the given (portfolio, date label) pairs."""
    # Safe to broadcast at any scale: distinct days, and a DATE column has no
    # more than 3.7 million values (about 30 MB) whatever the table size.
    on_cut_days = ordered.join(
        F.broadcast(cut_labels.select(LABEL).distinct()), LABEL, "left_semi"
    )
    return on_cut_days.join(cut_labels, [*keys, LABEL])
