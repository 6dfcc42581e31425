"""Building small staging tables by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.operators import spine

SNAPSHOT = (
    "portfolio_id bigint, primary_key bigint, datetime_now timestamp_ntz, date_now date, "
    "investment decimal(18,2)"
)
SERIES = (
    "portfolio_id bigint, primary_key bigint, datetime_stamp timestamp_ntz, date_stamp date, "
    "networth decimal(18,2), investment_amount decimal(18,2)"
)


def dec(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def snapshots(spark: SparkSession, readings: list[tuple]) -> DataFrame:
    """(portfolio, 'YYYY-MM-DD HH:MM:SS', amount[, key]) rows."""
    rows = []
    for number, (portfolio, when, amount, *key) in enumerate(readings):
        ts = at(when)
        rows.append((portfolio, key[0] if key else number, ts, ts.date(), dec(amount)))
    return spark.createDataFrame(rows, SNAPSHOT)


def series(spark: SparkSession, readings: list[tuple]) -> DataFrame:
    """(portfolio, timestamp text, net worth, invested[, key]) rows."""
    rows = []
    for number, (portfolio, when, networth, invested, *key) in enumerate(readings):
        ts = at(when)
        rows.append(
            (portfolio, key[0] if key else number, ts, ts.date(), dec(networth), dec(invested))
        )
    return spark.createDataFrame(rows, SERIES)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spine.calendar(spark.sql(f"SELECT DATE'{first}', DATE'{last}'"))


def day(text: str) -> date:
    return date.fromisoformat(text)
